"""Column functions: text, money, dates, ids and geometry. All of them stay in the JVM."""
