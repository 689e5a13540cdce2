"""The registered queries: each applies its operator, with production
parameters, to its whole table and derives the result columns agreed on."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runoff.llm import (
    collision_search,
    edit_counts,
    histogram_packing,
    html_text,
    merkle,
    mixing,
    ngram_join,
    packing,
    periodic_runs,
    quality,
    subspace_join,
    tool_calls,
    url_filter,
)
from runoff.llm.common import written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(_table(spark, sf_dir, "documents")).documents().select(
        "doc_id", "size", "source_size", "target", "taken")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op3_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_search.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id")


#: Tools of the op5 query's calls: parameter, type, whether it is required.
SCHEMAS = {"search": {"query": ("string", True), "limit": ("integer", True)},
           "translate": {"text": ("string", True), "to": ("string", False)},
           "count": {"words": ("array", True)}}


def conversation_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tool calls and results that ``conversations`` stand for: every user's
    row calls a tool with arguments made of its text, every assistant's row is
    a result.  A call's identifier names conversation, turn and text, so rows
    that say different things in one turn are different calls; rows without
    conversation or turn have none.  A call uses the first call (by identifier)
    of the user's turn before it, within its eight turns of the conversation;
    a result answers the first call of the turn before it."""
    at = ["conv_id", "turn"]
    rows = conversations.select(*at, "role", "text")
    place = F.concat(F.lit("call_"), F.col("conv_id"), F.lit("_"), F.col("turn"))
    own = F.concat(place, F.lit("_"), F.lpad(F.hex(F.crc32(F.coalesce("text", F.lit("")))), 8, "0"))
    users = rows.where("role = 'user'").withColumn("call_id", own)
    # at most eight rows a window: one for each turn that has a call
    first = users.where("call_id is not null").groupBy(*at).agg(F.min("call_id").alias("first"))
    eight = Window.partitionBy("conv_id", F.expr("turn div 8")).orderBy("turn")
    used = first.withColumn("used", F.lag("first").over(eight)).where("used is not null").select(*at, "used")
    n = F.coalesce(F.length("text"), F.lit(0))
    limit = F.when(n % 7 == 0, F.to_json(F.struct(F.lit("all").alias("limit"), F.col("text").alias("query")))).otherwise(
        F.to_json(F.struct(n.alias("limit"), F.col("text").alias("query"))))
    name = F.get(F.lit(sorted(SCHEMAS)), F.pmod(F.expr("turn div 2"), F.lit(3)).cast("int"))
    calls = users.withColumn("name", name).withColumn("arguments", F.when(F.col("name") == "search", limit)
                 .when(F.col("name") == "translate", F.to_json(F.struct("text", F.when(n % 2 == 0, "en").alias("to"))))
                 .otherwise(F.to_json(F.struct(F.split("text", " ", 5).alias("words")))))
    calls = calls.join(used, at, "left").select(*at, "call_id", "name", "arguments", F.array_compact(F.array("used")).alias("uses"))
    answers = rows.where("role = 'assistant'").withColumn("turn", F.col("turn") - 1).join(first, at, "left")
    return calls, answers.select(F.coalesce("first", place).alias("call_id"), F.col("text").alias("content"))


def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = conversation_calls(_table(spark, sf_dir, "conversations"))
    return tool_calls.format_calls(calls, results, SCHEMAS)


def derived_edits(docs: DataFrame) -> DataFrame:
    """``docs`` with edits: a replacement, a deletion and an insertion at
    places, and with words of the text, that hashes of the id choose."""
    n = F.coalesce(F.length("text"), F.lit(0))

    def h(k: int, below) -> Column:
        return F.pmod(F.xxhash64(F.lit(k), "doc_id"), F.greatest(below, F.lit(1)).cast("long")).cast("int")

    def edit(k: int, length: int, new: Column) -> Column:
        at = h(k, n + 1)
        return F.struct(at.alias("start"), (at + h(k + 1, F.lit(length))).alias("end"), new.alias("text"))

    def piece(k: int, length: int) -> Column:
        return F.substring(F.coalesce("text", F.lit("")), h(k, n) + 1, F.lit(length))

    return docs.withColumn("edits", F.array(
        edit(1, 40, piece(3, 30)), edit(4, 200, F.lit("")), edit(6, 1, F.concat(F.lit(" "), piece(8, 60)))))


def op6_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    docs = derived_edits(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    trees = edit_counts.with_trees(docs, path).withColumnRenamed("n_tokens", "n_tokens_before")
    return edit_counts.edited(trees, path, with_text=False).withColumnRenamed("n_tokens", "n_tokens_after")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.scores(docs, model).drop("text")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.token_pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    pieces = written(pieces.select("doc_id", "piece", "start", F.col("length"),
                                   F.crc32("ids").alias("ids_crc32")), "pieces")
    return packing.pack(pieces, ["doc_id", "piece", "ids_crc32", "length"]).withColumn(
        "length", F.col("length").cast("long"))


def op9_subspace_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspace_join.near_duplicates(_table(spark, sf_dir, "embeddings"))


#: The rule set of the op10 query: verdict, host, path.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), RULES).drop("url")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    fields = [F.col(c) for c in docs.columns]
    tampered = merkle.digest(*[f + 1 if c == "n_chars" else f for c, f in zip(docs.columns, fields)])
    shown = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, tampered)
    found = merkle.manifest(docs, F.col("lang"), F.col("doc_id"), merkle.digest(*fields), shown)
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"),
                        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``; a tenth of the documents, chosen by a hash
    of the id, repeat a stretch of their words from some word on to the end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    ws = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    words = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, ws).alias("ws"))
    n = F.size("ws").cast("long")
    first = words.select("doc_id", "text", "g", "ws", n.alias("n"), F.when(n > 0, F.col("g") % n).alias("a"))
    placed = first.withColumn("p", F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)) + 1)
    at = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get(
        "ws", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return placed.select("doc_id", F.when(F.col("n") > 0, F.array_join(at, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(planted_runs(_table(spark, sf_dir, "documents").select("doc_id", "text")))
    # by start, then period, so the first of equally strong runs stays
    top = F.aggregate("runs", F.get("runs", F.lit(0)), lambda best, r: F.when(
        r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = histogram_packing.token_pieces(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return histogram_packing.pack(pieces).drop("ids")


QUERIES = {f.__name__: f for f in (
    op1_source_mixing, op2_html_text, op3_collision_search, op4_ngram_join, op5_tool_calls, op6_edit_counts,
    op7_quality_classifier, op8_best_fit_packing, op9_subspace_join, op10_url_filter, op11_merkle_manifest,
    op12_periodic_runs, op13_histogram_packing)}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {**QUERIES, "pipeline": corpus_pipeline.run}


_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}, '-')"
_CRC32 = """xor(list_reduce(list_transform(range(8 * length({0})), lambda i: CASE WHEN i % 8 = 0
  THEN ord(substr({0}, i // 8 + 1, 1)) ELSE 0 END), lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1)),
  4294967295::BIGINT), 4294967295::BIGINT)"""
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{n_chars}", "text")) + ")"

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op11_merkle_manifest": rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, {_LEAF.format(n_chars="n_chars")} AS leaf, CASE WHEN {_CRC32.format("doc_id::VARCHAR")} % 7 = 0
    THEN {_LEAF.format(n_chars="(n_chars + 1)")} ELSE {_LEAF.format(n_chars="n_chars")} END AS shown FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
             count(*) OVER (PARTITION BY lang) AS n FROM d),
t(lang, level, i, n, h) AS (
  SELECT lang, 0, i, n, leaf FROM r
  UNION ALL
  SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM t WHERE n > 1
  GROUP BY lang, level, i // 2, n),
top AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS j FROM t WHERE n = 1),
u(level, i, n, h) AS (
  SELECT 0, j, count(*) OVER (), subroot FROM top
  UNION ALL
  SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM u WHERE n > 1
  GROUP BY level, i // 2, n),
step AS (
  SELECT r.lang, r.i, t.level, string_agg(t.h, '') FILTER (t.i < r.i >> t.level) AS l,
         string_agg(t.h, '') FILTER (t.i > r.i >> t.level) AS r
  FROM r JOIN t ON r.lang IS NOT DISTINCT FROM t.lang AND t.n > 1 AND t.i // 2 = r.i >> (t.level + 1) GROUP BY ALL
  UNION ALL
  SELECT r.lang, r.i, 1000 + u.level, string_agg(u.h, '') FILTER (u.i < top.j >> u.level),
         string_agg(u.h, '') FILTER (u.i > top.j >> u.level)
  FROM r JOIN top ON r.lang IS NOT DISTINCT FROM top.lang JOIN u ON u.n > 1 AND u.i // 2 = top.j >> (u.level + 1)
  GROUP BY ALL),
path AS (
  SELECT lang, i, list({{'h': '', 'l': coalesce(l, ''), 'r': coalesce(r, '')}} ORDER BY level) AS steps FROM step GROUP BY lang, i),
folded AS (
  SELECT r.doc_id, r.lang, r.leaf, array_to_string(list_transform(coalesce(steps, []), lambda x: x.l || x.r), '') AS proof,
         list_reduce(coalesce(steps, []), lambda a, x: {{'h': sha256(x.l || a.h || x.r), 'l': '', 'r': ''}},
                     {{'h': shown, 'l': '', 'r': ''}}).h AS folded_root
  FROM r LEFT JOIN path ON r.lang IS NOT DISTINCT FROM path.lang AND r.i = path.i)
SELECT doc_id, leaf, top.subroot, u.h AS root, sha256(proof) AS proof_sha256, folded_root, folded_root = u.h AS verified
FROM folded JOIN top ON folded.lang IS NOT DISTINCT FROM top.lang JOIN u ON u.n = 1""",
    "op9_subspace_join": """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS norm FROM v),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
         WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.95),
n AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY 1),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT reach.vec_id, link.b FROM reach JOIN link ON reach.other = link.a),
c AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)""",
    "op10_url_filter": r"""
WITH part AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
cut AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM part),
u AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM cut),
r(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fit AS (
  SELECT u.page_id, u.host, u.path, r.rhost || r.rpath AS rule, r.verdict
  FROM u LEFT JOIN r ON (u.host = r.rhost OR ends_with(u.host, '.' || r.rhost)) AND starts_with(u.path, r.rpath))
SELECT page_id, any_value(host) AS host, any_value(path) AS path, arg_max(rule, length(rule)) AS rule,
       coalesce(arg_max(verdict, length(rule)), 'allow') AS verdict
FROM fit GROUP BY page_id""",
    "op4_ngram_join": rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
                      WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(ws) - 3),
                                                        lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh
  FROM w),
t AS (SELECT doc_id, unnest(sh) AS tok FROM s),
size AS (SELECT doc_id, len(sh)::BIGINT AS n FROM s),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
         FROM t a JOIN t b ON a.tok = b.tok AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
         WHERE 100 * k >= 75 * (x.n + y.n - k)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, link.b FROM reach JOIN link ON reach.other = link.a)
SELECT doc_id, any_value(n) AS n_shingles, min(other) AS component_id
FROM reach JOIN size USING (doc_id) GROUP BY doc_id""",
}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    extra = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**ORACLES, **extra}
