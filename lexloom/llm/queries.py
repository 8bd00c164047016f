"""One query for each operator over its whole table, with production parameters; SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm import arc_tables, langid, mixing, quality, rp_forest, sentencepiece_codec, simhash, tiff, token_count, url_filter
from lexloom.llm.runtime import bounded_batches, staged

MAX_TOKENS = 512
ROW_BYTES = 192


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document with the tokens of its whole text; a null text counts as empty, rows with equal ids stay apart."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_count.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > MAX_TOKENS).alias("over_limit"))


#: Target weights, in thousandths; names not listed have the last value.
DOMAIN_WEIGHTS, LANG_WEIGHTS, SOURCE_WEIGHTS = {"web": 400, "news": 200, "forum": 150, "reference": 200, "*": 50}, {"en": 500, "de": 200, "fr": 200, "es": 100, "*": 50}, {"*": 1}
#: Part of all tokens, epochs included, that the mixture takes, in tenths.
BUDGET_TENTHS = 6
MAX_EPOCHS = 2


def domain_of(source: Column) -> Column:
    """Sources come numbered; five in a row are a domain."""
    n = F.regexp_extract(F.coalesce(source, F.lit("")), r"^src(\d{1,6})$", 1)
    k = F.when(n == "", F.lit(None)).otherwise(F.expr("cast(nullif(regexp_extract(coalesce(source, ''), '^src([0-9]{1,6})$', 1), '') as int) div 5"))
    return F.when(k == 0, "web").when(k == 1, "news").when(k == 2, "forum").when(k == 3, "reference").otherwise("other")


def weight(name: Column, weights: dict[str, int]) -> Column:
    out = F.lit(weights["*"])
    for key, w in weights.items():
        if key != "*":
            out = F.when(name == key, w).otherwise(out)
    return out


def mixed(docs: DataFrame, max_epochs: int, tenths: int, id_col: str = "doc_id") -> DataFrame:
    return mixing.mix(
        docs,
        levels={"domain": domain_of(F.col("source")), "lang": F.col("lang"), "source": F.col("source")},
        weights={"domain": weight(F.col("domain"), DOMAIN_WEIGHTS), "lang": weight(F.col("lang"), LANG_WEIGHTS), "source": weight(F.col("source"), SOURCE_WEIGHTS)},
        budget=F.expr(f"sum(cap) * {tenths} div 10"),
        tokens=mixing.word_count(F.col("text")),
        id_col=id_col,
        max_epochs=max_epochs,
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that the target weights take, with their whole epochs and the part of the last one; null and empty texts give no row."""
    return mixed(table(spark, sf_dir, "documents"), MAX_EPOCHS, BUDGET_TENTHS)


def _children(name: str, parent: list[str], weights: str, above: str) -> str:
    """SQL that divides a parent's budget among children, as ``mixing.divide_budget`` does."""
    key = ", ".join([*parent, name])
    over = f"partition by {', '.join(parent)}" if parent else ""
    on = " and ".join(f"c.{p} is not distinct from a.{p}" for p in parent) or "true"
    order = f"order by case when w > 0 then cap::double / w else 'infinity'::double end, {name} nulls first"
    return f"""
{name}_c as (select {", ".join(f"c.{k.strip()}" for k in key.split(","))}, c.w, case when c.w > 0 then c.cap else 0 end::hugeint as cap, a.budget
  from (select {key}, sum(cap)::hugeint as cap, max({weights})::hugeint as w from leaf_caps group by {key}) c join {above} a on {on}),
{name}_1 as (select *, least(budget, sum(cap) over ({over}))::hugeint as b,
    coalesce(sum(cap) over ({over} {order} rows between unbounded preceding and 1 preceding), 0)::hugeint as before,
    (sum(w) over ({over} {order} rows between current row and unbounded following))::hugeint as ws from {name}_c),
{name}_2 as (select *, (w = 0 or cap * ws <= w * (b - before)) as filled from {name}_1),
{name}_3 as (select *, (b - coalesce(sum(case when filled then cap end) over ({over}), 0))::hugeint as rest, (sum(case when filled then 0 else w end) over ({over}))::hugeint as split from {name}_2),
{name}_4 as (select *, case when filled then 0 else (w * rest) // split end as even from {name}_3),
{name}_5 as (select *, rest - sum(even) over ({over}) as odd, sum(case when filled then 0 else 1 end) over ({over} {order} rows between unbounded preceding and current row) as place from {name}_4),
{name}_s as (select {key}, (case when filled then cap else even + case when place <= odd then 1 else 0 end end)::bigint as budget from {name}_5)"""


def _sql_weight(column: str, weights: dict[str, int]) -> str:
    cases = " ".join(f"when '{k}' then {v}" for k, v in weights.items() if k != "*")
    return f"case {column} {cases} else {weights['*']} end" if cases else str(weights["*"])


OP2_SQL = f"""
with docs as (select doc_id, lang, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as n_tokens,
    case try_cast(regexp_extract(coalesce(source, ''), '^src([0-9]{{1,6}})$', 1) as integer) // 5 when 0 then 'web' when 1 then 'news' when 2 then 'forum' when 3 then 'reference' else 'other' end as domain from documents),
own as (select * from docs where n_tokens > 0),
leaves as (select domain, lang, source, sum(n_tokens)::bigint as held from own group by domain, lang, source),
leaf_caps as (select *, held * {MAX_EPOCHS} as cap, {_sql_weight("domain", DOMAIN_WEIGHTS)} as domain_w, {_sql_weight("lang", LANG_WEIGHTS)} as lang_w, {_sql_weight("source", SOURCE_WEIGHTS)} as source_w from leaves),
root as (select (sum(cap) * {BUDGET_TENTHS} // 10)::hugeint as budget from leaf_caps),
{_children("domain", [], "domain_w", "root")},
{_children("lang", ["domain"], "lang_w", "domain_s")},
{_children("source", ["domain", "lang"], "source_w", "lang_s")},
plan as (select s.domain, s.lang, s.source, s.budget // l.held as full_epochs, s.budget % l.held as part
  from source_s s join leaves l on s.domain = l.domain and s.lang is not distinct from l.lang and s.source is not distinct from l.source),
dealt as (select o.*, p.full_epochs, p.part, md5('mix:' || p.full_epochs || ':' || coalesce(o.doc_id::varchar, '')) as h
  from own o join plan p on o.domain = p.domain and o.lang is not distinct from p.lang and o.source is not distinct from p.source),
summed as (select *, sum(n_tokens) over (partition by domain, lang, source order by h, doc_id nulls first, n_tokens rows between unbounded preceding and current row) as upto from dealt),
taken as (select doc_id, domain, lang, source, n_tokens, full_epochs, greatest(0, least(n_tokens, part - upto + n_tokens))::bigint as partial_tokens from summed)
select doc_id, domain, lang, source, n_tokens, full_epochs::bigint as full_epochs, partial_tokens, (full_epochs * n_tokens + partial_tokens)::bigint as tokens_taken from taken where full_epochs * n_tokens + partial_tokens > 0
"""


def as_tiff(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes, content): each text's UTF-8 bytes, filled with spaces to whole rows, as a TIFF.

    Null and empty texts are one row of spaces; equal texts give equal files, rows with equal or null ids
    stay apart; other columns are left aside; an empty table stays empty.  A file is held in memory whole.
    """
    import pyarrow as pa

    bounded_batches(docs.sparkSession)

    def store(batches):
        for batch in batches:
            sizes, files = [], []
            for text in batch.column(1).to_pylist():
                data = (text or "").encode()
                sizes.append(len(data))
                files.append(tiff.payload_tiff(data + b" " * (-len(data) % ROW_BYTES if data else ROW_BYTES), ROW_BYTES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(files, pa.binary())], names=[id_col, "n_bytes", "content"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(store, f"{id_col} long, n_bytes long, content binary")


def op3_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text stored as a TIFF, read back, one row per page; a null text is a payload of 192 spaces."""
    stored = staged(as_tiff(table(spark, sf_dir, "documents")), "tiff")
    media = stored.withColumns({"media_bytes": F.octet_length("content").cast("long"), "media_sha256": F.sha2("content", 256)})
    pages = tiff.tiff_pages(media, "content", ["doc_id", "n_bytes", "media_bytes", "media_sha256"])
    feature = F.concat_ws(";", F.concat_ws("x", "width", "height", "samples"), F.concat(F.lit("compression="), "compression"), F.concat(F.lit("predictor="), "predictor"), F.when(F.col("tiled"), "tiles").otherwise("strips"), F.concat(F.lit("first="), F.hex(F.substring("pixels", 1, 8))))
    return pages.select(
        "doc_id", "n_bytes", F.octet_length("pixels").cast("long").alias("payload_bytes"), F.sha2("pixels", 256).alias("payload_sha256"),
        F.crc32(F.substring("pixels", -16, 16)).alias("tail_crc32"), "media_bytes", "media_sha256", feature.alias("feature"), "page", "error",
    )


def op4_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through ARC and WARC archives; a null html is an empty payload, repeated rows are records of their own."""
    read = arc_tables.pages_through_archives(table(spark, sf_dir, "pages"))
    return read.select(F.col("record_key").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.col("refers_to_key").alias("refers_to"))


OP4_SQL = """
with own as (select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha1(coalesce(html, '')) as hex from pages),
digested as (select page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda j:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(hex, (j // 4 * 5 + 1)::int, 5))::int) >> (15 - 5 * (j % 4))::int) & 31) + 1, 1)), '') as payload_digest from own),
firsts as (select *, max(page_id) over (partition by payload_digest) as first_id from digested)
select page_id, payload_bytes, payload_digest, case when page_id = first_id then 'response' else 'revisit' end as record_type, case when page_id <> first_id then first_id end as refers_to from firsts
"""


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fingerprint and a component for every document; documents without words have fingerprint zero and link with each other."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, max_bits=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex(F.col("fps")[0])), 16, "0").alias("fingerprint"), "component_id")


#: Documents with a lower score are rejected.
QUALITY_THRESHOLD = 0.5


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and decision for every document; null, empty and blank texts get 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.classify(docs, quality.fit(docs))
    return scored.select("doc_id", "quality_score", (F.col("quality_score") >= QUALITY_THRESHOLD).alias("kept"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; only rows that are not held out are learned from, a null id is not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False)))
    model = langid.train(docs.where("not held_out"), "text", "lang")
    found = langid.identify(docs, model)
    return found.select("doc_id", "held_out", F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether they decode to its text; null and empty texts have no ids.

    The model is a BPE model, whose scores are merge ranks: the single pass over the automaton's output
    links keeps at each position the piece that agrees with the one before it, not a best sum of scores,
    which only a unigram model means.
    """
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = sentencepiece_codec.encode_and_decode(docs, path).select("doc_id", "text", "coded.*")
    # The model writes a space as U+2581, so that character comes back as a space.
    exact = F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), sentencepiece_codec.SPACE, " ")
    return both.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), F.octet_length("decoded").cast("long").alias("decoded_bytes"), exact.alias("round_trip"))


def op9_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors; what can not be compared (null, zero, not finite, no label) is alone."""
    return rp_forest.vector_links(table(spark, sf_dir, "embeddings"), threshold=0.98)


OP9_SQL = """
with recursive v as (select vec_id, label, embedding::double[] as e from embeddings
    where label is not null and embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0 and len(list_filter(embedding, lambda c: c <> 0)) > 0),
links as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.98),
reach as (select distinct a, b from links union select r.a, l.b from reach r join links l on l.a = r.b)
select vec_id, (select count(*) from links where a = vec_id)::bigint as n_links, least(vec_id, coalesce((select min(b) from reach where a = vec_id), vec_id)) as component_id,
    vec_id = least(vec_id, coalesce((select min(b) from reach where a = vec_id), vec_id)) as kept from embeddings
"""

RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page; trees trained on the URLs that rules decide judge the rest, null urls among them."""
    judged = url_filter.judge_with_rule_labels(table(spark, sf_dir, "pages").select("page_id", "url"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "block_probability")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the five stages of ``corpus_pipeline`` keep of the documents, as ids."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_mixing, op3_tiff, op4_arc_to_warc, op5_simhash, op6_quality, op7_language, op8_sentencepiece, op9_vector_dedup, op10_url_filter, pipeline)}
SQL = {"op2_mixing": OP2_SQL, "op4_arc_to_warc": OP4_SQL, "op9_vector_dedup": OP9_SQL}
