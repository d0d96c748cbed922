"""Column functions on literals."""

import random

import pytest
from pyspark.sql import functions as F

from filigree.functions import dates, geo, ids, money, text


def value(spark, column, **given):
    names = list(given)
    kinds = {str: "string", int: "bigint", float: "double"}
    row = spark.createDataFrame([tuple(given.values())], ", ".join(f"{n} {kinds[type(given[n])]}" for n in names))
    out = row.select(column.alias("x")).first().x
    return out


@pytest.mark.parametrize(("flavour", "html", "want"), [
    ("spaced", "a<b>c</b>&amp;nbsp;&#8217;d", "a c &nbsp;'d"),
    ("joined", "Item&#160;5.<i>07</i> x", "Item 5.07 x"),
    ("lines", "<table><tr><td>A</td><td>B</td></tr></table>", None),
    ("collapsed", "<p> a  b </p>\n c", "a b c"),
    ("cells", " <b>x</b> &#8212; ", "x -"),
    ("plain", "a &amp; <b>b", "a &amp;  b"),
    ("paged", "a > b<hr>c", "a > b\n<<PAGE>>\nc"),
    ("spaced", "keep <open tag", "keep "),
])
def test_strip_html(spark, flavour, html, want):
    got = value(spark, text.strip_html(F.col("h"), flavour), h=html)
    if want is None:
        assert [x for x in got.split("\n") if x.strip()] == ["A", "B"]
    else:
        assert got == want


@pytest.mark.parametrize(("name", "want"), [("Wilma Q. Harrow-Tate", "wilma-q-harrowtate"), ("O'Neil-Smith, Jr.", "oneilsmith-jr"), (" x ", "x"), ("", "")])
def test_normalise_name(spark, name, want):
    assert value(spark, text.normalise_name(F.col("n")), n=name) == want


@pytest.mark.parametrize(("html", "codes"), [
    ("<p>Item 1.01 Entry.</p><p>Item 9.01 Exhibits</p><p>Item 5.02 Departure</p>", ["1.01", "5.02", "9.01"]),
    ("Item 5.02 Departure. Item 5.02 Again", ["5.02"]),
    ("see below Item 5.02 in last year's paper", []),
    ("Item&nbsp;1.01 Entry", ["1.01"]),
    ("Item 5.020 Wrong Item 5.0 Wrong", []),
    ("", []),
])
def test_eightk_items(spark, html, codes):
    assert [i.item_code for i in value(spark, text.eightk_items(F.col("h")), h=html)] == codes


def test_ids(spark):
    assert value(spark, ids.strip_leading_zeros(F.col("x")), x="00012") == "12"
    assert value(spark, ids.strip_leading_zeros(F.col("x")), x="000") == value(spark, ids.strip_leading_zeros(F.col("x")), x="") == "0"
    assert value(spark, ids.insert_accession_dashes(F.col("x")), x="000066041224000123") == "0000660412-24-000123"
    assert value(spark, ids.insert_accession_dashes(F.col("x")), x="12") == "12"
    assert tuple(value(spark, ids.filing_path_parts(F.col("x")), x="file:/r/660412/0000-1/a.htm")) == ("660412", "0000-1", "a.htm")
    assert value(spark, ids.stem(F.col("x")), x="a/b/field.csv") == "field"
    assert value(spark, ids.is_exhibit21(F.col("x")), x="lkm-ex21.htm") and not value(spark, ids.is_exhibit21(F.col("x")), x="lkm-8k.htm") and not value(spark, ids.is_exhibit21(F.col("x")), x="ex-21.pdf")
    assert value(spark, ids.is_information_table(F.col("x")), x="13f-infotable.xml")


@pytest.mark.parametrize(("said", "want"), [("$168 million net", 168e6), ("$87,540 a year", 87540.0), ("$1.5 billion", 1.5e9), ("none", None), ("$5 for one", 5.0)])
def test_first_dollar(spark, said, want):
    assert value(spark, money.first_dollar(F.col("s")), s=said) == want


def test_money(spark):
    span = lambda s: tuple(value(spark, money.price_range(F.col("s")), s=s))
    assert span("prices ranging from $2,204.00 to $2,205.50, inclusive.") == (2204.0, 2205.5)
    fixed = money.repaired_price(F.col("p"), F.lit(2204.0), F.lit(2205.5))
    assert value(spark, fixed, p=2204750.0) == 2204.75 and value(spark, fixed, p=2204.5) == 2204.5
    assert [value(spark, money.clean_money(F.col("c")), c=c) for c in ("—", "(5)", "$1,200", "x")] == [0.0, None, 1200.0, None]
    assert [value(spark, money.clean_numeric(F.col("c")), c=c) for c in ("1,234*", "8.2%", "(1)", "Smith")] == ["1234", "8.2", "1", ""]
    assert [value(spark, money.format_float(F.col("x")), x=x) for x in (0.0, 60.0, 1e10, 0.1, 12345678.5)] == ["", "60", "10000000000", "0.1", "12345678.5"]
    assert [value(spark, money.format_float(F.col("x")), x=x) for x in (2e23, 95e20, -2e23, 0.1 + 0.2, 1e-7, 123456789012345680.0, 1.7976931348623157e308, 9007199254740993.0)] == [
        "2" + "0" * 23, "95" + "0" * 20, "-2" + "0" * 23, "0.30000000000000004", "0.0000001", "123456789012345680", "17976931348623157" + "0" * 292, "9007199254740992"]
    assert value(spark, money.ratio_to_one(F.col("s")), s="The ratio in 2024 was 312 to 1.") == 312.0
    low = F.lower(F.col("s"))
    assert value(spark, money.nearest_decimal(F.col("s"), low, ["per diluted share"]), s="or a loss of ($0.42) per diluted share, 9.99 later") == -0.42
    assert value(spark, money.digits_only(F.col("s")), s="a1b2") == 12


def test_amounts_and_ratios_are_no_years(spark):
    year = lambda s: value(spark, dates.max_year(F.col("s"), F.lit(0), 400, dates.NO_AMOUNT), s=s)
    assert [year(s) for s in ("In 2023: $ 2024, $2025", "2023 CEO pay ratio: 2050 to 1", "ratio 2051:1 in 2024", "In 2023: 1,000 or 2022: 15")] == [2023, 2023, 2024, 2023]
    ratio = lambda s: value(spark, money.ratio_to_one(F.col("s")), s=s)
    assert [ratio(s) for s in ("The ratio was 2000 to 1.", "The ratio was 123456 to 1.", "The ratio of 2024: 1", "The ratio in 1999 to 1 a pay ratio was 312:1", "ratio 1 to 1")] == [2000.0, 123456.0, None, 312.0, None]


def test_dates(spark):
    assert value(spark, dates.epoch_ms_date(F.col("x")), x=946684800000) == "2000-01-01"
    assert value(spark, dates.max_year(F.col("s")), s="2024, 2023 and 12024") == 2024
    assert value(spark, dates.first_year(F.col("s")), s="page 1234 of 1999 and 2001") == 1999
    assert value(spark, dates.effective_date(F.col("s")), s="On May 1, 2023 he said, effective June 2, 2024.") == "June 2, 2024"
    assert value(spark, dates.year_prefix(F.col("s")), s="20x4-01-01") is None
    assert dates.is_date_column("wlbEntryDate") and not dates.is_date_column("name")


@pytest.mark.parametrize(("geometry", "want"), [
    ('{"type":"Point","coordinates":[1.5,60]}', "POINT(1.5 60)"),
    ('{"type":"Point","coordinates":[1e20,-1e-13,5]}', "POINT(100000000000000000000 -0.0000000000001)"),
    ('{"type":"Point","coordinates":[1.1234567890123456,123456789.5]}', "POINT(1.1234567890123457 123456789.5)"),
    ('{"type":"MultiPoint","coordinates":[[1,2],[3,4]]}', "MULTIPOINT(1 2, 3 4)"),
    ('{"type":"MultiPoint","coordinates":[[1],["3",4],null,[5,6]]}', "MULTIPOINT(5 6)"),
    ('{"type":"LineString","coordinates":[[1,2]]}', None),
    ('{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]],[[2,2],[3,3]]]}', "POLYGON((0 0, 1 0, 1 1, 0 0))"),
    ('{"type":"Polygon","coordinates":[]}', None),
    ('{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]],[[[1,1]]]]}', "MULTIPOLYGON(((0 0, 1 0, 1 1, 0 0)))"),
    ('{"type":"Point","coordinates":["x"]}', None),
    ('{"type":"Circle","coordinates":[1,2]}', None),
    ('{"type":"Point"}', None),
    ("nonsense", None),
])
def test_wkt(spark, geometry, want):
    assert value(spark, geo.wkt(F.col("g")), g=geometry) == want


def test_geometries_with_something_left_out_are_rewritten_as_text(spark, monkeypatch):
    """Plain and nested forms give the same text as taking the geometry apart does."""
    shapes = {
        "Point": ["[1,2]", "[1]", '["3",4]'], "MultiPoint": ["[[1],[2,3],[4]]", "[[1]]", '[[1,"2"],[3,4]]'], "LineString": ["[[1,2]]", "[[1],[1,2],[3],[4,5,6]]", "[[1]]"],
        "Polygon": ["[[[0,0],[1,0],[2],[1,1]],[[1,1],[2,2]]]", "[[[1,1],[2,2]],[[0,0],[1,0],[1,1]]]", "[[[1,1]]]", "[[[1],[2]]]"],
        "MultiPolygon": ['[[[[0,0],[1],["2",3],[5,0],[0,-7.25,9]],[[1,1],[2,2]]],[[[3,3],[4,5]]]]', "[[[[1,1]]],[[[0,0],[1,0],[1,1]]],[[[2]]]]", "[[[[1,1]]]]", "[[[[1]]]]"],
    }
    texts = spark.createDataFrame([(f'{{"type":"{k}","coordinates":{x}}}',) for k, xs in shapes.items() for x in xs], "g string").cache()
    fast = [r.w for r in texts.select(geo.wkt(F.col("g")).alias("w")).collect()]
    whole = F.concat(F.get_json_object("g", "$.type"), F.get_json_object("g", "$.coordinates"))
    assert [r.n for r in texts.select((geo._plain(whole) | geo._nested(whole)).alias("n")).collect()] == [True] * len(fast)
    for name in ("_plain", "_nested"):
        monkeypatch.setattr(geo, name, lambda s: F.lit(False))
    assert fast == [r.w for r in texts.select(geo.wkt(F.col("g")).alias("w")).collect()]


def test_geometries_are_rewritten_a_batch_at_once(spark, monkeypatch):
    """Mixed batches with long numbers, blanks and other orders of members give the same texts as taking geometries apart does; those in the usual form need not be."""
    pick = random.Random(4)
    number = lambda: pick.choice(["0", "-1", "7", "-12.5", "0.00015", "99999999", "123456789012345", "1234567.00000009", "60000000.5", "-1.000000890123"])
    point = lambda: pick.choice(["[{0},{1}]"] * 6 + ["[{0},{1},{2}]", "[{0}]", '["~",{0}]', '[{0},"é"]', '["a","b",{0},{1}]']).format(number(), number(), number())
    several = lambda of, most=5: "[" + ",".join(of() for _ in range(pick.randint(1, most))) + "]"
    polygon = lambda: several(lambda: several(point), 3)
    kinds = {"Point": point, "MultiPoint": lambda: several(point), "LineString": lambda: several(point, 3), "Polygon": polygon, "MultiPolygon": lambda: several(polygon, 3)}
    pairs = [(k, make()) for k, make in kinds.items() for _ in range(60)]
    pick.shuffle(pairs)
    forms = ['{{"type":"{}","coordinates":{}}}', '{{"coordinates":{1},"type":"{0}"}}', '{{ "type" : "{}", "coordinates" : {} }}', '{{"type":"{}","bbox":[1,2],"coordinates":{}}}']
    texts = spark.createDataFrame([(n, forms[n % 7 if n % 7 < 4 else 0].format(*pair)) for n, pair in enumerate(pairs)], "n int, g string").coalesce(1).cache()
    fast = dict(texts.select("n", geo.wkt(F.col("g"))).collect())
    s = geo._short(F.col("g"))
    assert texts.where(~(F.col("n") % 7).between(1, 3)).where((geo._plain(s) | geo._nested(s)).isNull()).count() == 0 < len(fast) == 300
    for name in ("_plain", "_nested"):
        monkeypatch.setattr(geo, name, lambda s: F.lit(False))
    assert fast == dict(texts.select("n", geo.wkt(F.col("g"))).collect())


def test_texts_that_only_look_like_geometries_have_none(spark):
    odd = ["Point[1,2]", '{"type":"Point[1,2]}', '{"type":"Point","coordinates":[01,2]}', '{"type":"Point","coordinates":[]}', ' {"type":"","coordinates":{"type":"Point","coordinates":[1,2]}}', "", None]
    broken = spark.sql("""select cast(concat(cast('{"type":"Point","coordinates":["' as binary), x'ff', cast('",1]}' as binary)) as string)""")
    texts = spark.createDataFrame([(x,) for x in odd], "g string").union(broken).coalesce(1)
    assert [r.w for r in texts.select(geo.wkt(F.col("g")).alias("w")).collect()] == [None] * (len(odd) + 1)


def test_long_rings_and_numbers_are_rewritten(spark):
    assert value(spark, geo._plain(F.col("s")), s="LineString[[216000000,60000000],[60000000.5,7]]")
    ring = ",".join(f"[{n},{n}.5]" for n in range(50_000))
    wanted = "POLYGON((" + ", ".join(f"{n} {n}.5" for n in range(50_000)) + "))"
    assert value(spark, geo.wkt(F.col("g")), g=f'{{"type":"Polygon","coordinates":[[{ring}],[[1]]]}}') == wanted
