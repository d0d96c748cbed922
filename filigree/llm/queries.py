"""One thin query for each operator, over its whole table, with digests derived from the operator's output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filigree.llm import bpe, decontaminate, divergence, htmltext, langid, neardup, pii, quality, search, secrets, spotsigs, suffixes, toxicity
from filigree.llm.common import Workspace, broadcast_if, table, train_row

VOCABULARY = "byte_bpe_50k.json"
#: Up to so many labelled ids are broadcast to the scan of documents; more are joined by a shuffle.
BROADCAST_LABELS = 1_000_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def of_kind(kind: str):
    return lambda s: s["kind"] == kind


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = secrets.update(docs, f"{Workspace(spark, 'secrets').root}/ledger")
    found = secrets.findings(docs, ledger)
    kinds = [r.kind for r in secrets.BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    counts = [F.size(F.filter("spans", of_kind(k))).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(secrets.rendered(base), 256).alias("base_sha256"), secrets.rendered(F.col("spans")).alias("spans"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learned = train_row(F.col("doc_id"), 5, 0)
    labels = table(spark, sf_dir, "labels").where(learned & F.col("toxic").isNotNull()).select("doc_id", "toxic")
    prior = labels.agg(F.avg("toxic")).first()[0] or 0.0
    confirmed = docs.join(broadcast_if(labels.where("toxic = 1").select("doc_id"), BROADCAST_LABELS), "doc_id", "left_semi")
    model = toxicity.learn(confirmed, docs.where(learned), prior)
    return toxicity.predict(docs, model).select("doc_id", (~learned).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", F.size("hit").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (F.size("hit") > 0).alias("contaminated"))


def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    buckets = 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spotsigs.with_next(docs, buckets).withColumn("edited", spotsigs.edited(F.col("text"), F.col("next_text")))
    rows = rows.withColumn("edited_signatures", spotsigs.signatures(spotsigs.words_text(F.col("edited"))))
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", spotsigs.fingerprint(F.col("edited_signatures")).alias("edited_fingerprint"),
        spotsigs.likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"), spotsigs.likeness(F.col("signatures"), F.col("next_signatures")).alias("near_next"),
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learned = train_row(F.col("doc_id"), 4, 2)
    model = langid.learn(docs.where(learned))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (~learned).alias("held_out"), "lang_pred", "score")


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_documents(docs, vocabulary_path(), ("n_tokens", "ids_sha256", "decoded_sha256")).drop("text")


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learned = train_row(F.col("doc_id"), 5, 0)
    labels = table(spark, sf_dir, "labels").where(learned & F.col("quality").isNotNull()).select("doc_id", F.col("quality").alias("label"))
    model = quality.learn(docs.join(broadcast_if(labels, BROADCAST_LABELS), "doc_id"), threshold=0.3)
    return quality.predict(docs, model).select("doc_id", (~learned).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"), keep_text=False)


def op11_block_max_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    counts = [F.size(F.filter("spans", of_kind(k))).cast("long").alias(f"n_{k}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(secrets.rendered(base), 256).alias("base_sha256"), secrets.rendered(F.col("spans")).alias("spans"))


QUERIES = {
    "op1_secret_scans": op1_secret_scans,
    "op2_toxicity": op2_toxicity,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_spotsigs": op4_spotsigs,
    "op5_language_id": op5_language_id,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_bpe": op7_bpe,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_quality": op9_quality,
    "op10_html_extraction": op10_html_extraction,
    "op11_block_max_wand": op11_block_max_wand,
    "op12_divergence": op12_divergence,
    "op13_pii": op13_pii,
}

_WORDS = r"list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


def _spans_sql(kind: str, pattern: str, group: int, least: int) -> str:
    whole = f"'(?s)(.*?)({pattern})'".replace("\"'", "\"''")
    told = 2 + group
    return f"""
    select doc_id, '{kind}' as kind, s as start, s + length(hits[i]) as stop
    from (
        select doc_id, hits, told, i, cast(coalesce(list_sum(list_transform(gaps[1:i], lambda g: length(g))), 0) + coalesce(list_sum(list_transform(hits[1:i-1], lambda g: length(g))), 0) as bigint) as s
        from (select doc_id, gaps, hits, told, unnest(range(1, len(hits) + 1)) as i from (
            select doc_id, regexp_extract_all(coalesce(text, ''), {whole}, 1) as gaps, regexp_extract_all(coalesce(text, ''), {whole}, 2) as hits, regexp_extract_all(coalesce(text, ''), {whole}, {told}) as told from documents))
    ) where length(told[i]) >= {least}"""


_SPANS = " union all ".join(f"select *, {n} as rank from ({_spans_sql(r.kind, r.pattern, *r.least)})" for n, r in enumerate(secrets.RULES))

ORACLE = {
    "op1_secret_scans": f"""
with spans as ({_SPANS}), per_doc as (
    select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
        string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank, stop) filter (rank < {len(secrets.BASE)}) as base,
        string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank, stop) as spans
    from spans group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents d left join per_doc p on d.doc_id = p.doc_id""",
    "op3_benchmark_decontamination": f"""
with b as (select item_id, {_WORDS} as w from benchmark), g as (
    select distinct item_id, k, array_to_string(w[i:i+k-1], ' ') as gram from (
        select item_id, w, k, unnest(range(1, len(w) - k + 2)) as i from (select item_id, w, least(10, len(w)) as k from b where len(w) > 0))),
d as (select doc_id, {_WORDS} as w from documents),
runs as (select doc_id, k, i, array_to_string(w[i:i+k-1], ' ') as gram from (
    select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from d cross join (select distinct k from g))),
hits as (select doc_id, i, g.k, item_id from runs join g on runs.k = g.k and runs.gram = g.gram),
n as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + k)) as p from hits) group by doc_id),
it as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join n on d.doc_id = n.doc_id left join it on d.doc_id = it.doc_id""",
    "op11_block_max_wand": r"""
with w as (select doc, doc_id, unnest(list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) as term
    from (select doc_id, text, row_number() over () as doc from documents)),
n as (select doc, doc_id, cast(count(*) as bigint) as n from w group by all),
s as (select cast(count(*) as bigint) as docs, cast(sum(n) as bigint) as terms from n),
q as (select distinct item, item_id, unnest(list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) as term
    from (select item_id, text, row_number() over () as item from benchmark)),
p as (select doc, term, cast(count(*) as bigint) as tf from w where term in (select term from q) group by all),
d as (select term, cast(count(*) as bigint) as df from p group by all),
i as (select doc, doc_id, term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double)) as bigint) * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms))) as added
    from p join d using (term) join n using (doc) cross join s),
r as (select item_id, item, doc_id, cast(sum(added) as bigint) as score from q join i using (term) group by item_id, item, doc, doc_id)
select item_id, cast(rank as integer) as rank, doc_id, score from (select *, row_number() over (partition by item order by score desc, doc_id) as rank from r where score > 0) where rank <= 10""",
    "op12_divergence": r"""
with w as (select coalesce(lang, '') as lang, coalesce(source, '') as source, doc, unnest(list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) as term
    from (select lang, source, text, row_number() over () as doc from documents)),
kept as (select lang, term, cast(count(*) as bigint) as lang_count from w group by all having count(distinct doc) >= 3),
c as (select w.lang, source, term, cast(count(*) as bigint) as c from w join kept using (lang, term) group by all),
v as (select lang, cast(count(*) as bigint) as v, cast(sum(lang_count) as bigint) as lang_n from kept group by lang),
g as (select g.lang, g.source, coalesce(v, 0) as v, lang_n, cast(coalesce(n, 0) as bigint) as n from (select distinct coalesce(lang, '') as lang, coalesce(source, '') as source from documents) g
    left join v using (lang) left join (select lang, source, sum(c) as n from c group by all) using (lang, source)),
dense as (select g.lang, g.source, k.term, coalesce(c.c, 0) as c, k.lang_count, 1 + (1000000000 * (coalesce(c.c, 0) + 1)) // (g.n + g.v) as p, 1 + (1000000000 * (k.lang_count + 1)) // (g.lang_n + g.v) as q
    from g join kept k using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
pairs as (select a.lang, a.source, b.source as item, cast(sum((a.p - b.p) * (a.p - b.p) // b.p) as bigint) as value from dense a join dense b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
every as (select lang, a.source, b.source as item, coalesce(value, 0) as value from g a join g b using (lang) left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source where a.source <> b.source),
terms as (select lang, source, term as item, (p - q) * (p - q) // q as value from dense where c > 0 and p > q),
ranks as (select 'pair' as part, *, row_number() over (partition by lang, source order by value desc, item) as rank from every union all select 'term', *, row_number() over (partition by lang, source order by value desc, item) from terms)
select lang, source, part, item, value, rank from ranks where part = 'pair' or rank <= 200""",
}
