"""The operators' registered queries, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from .packed import ready

    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import remove_repeats

    docs = table(spark, sf_dir, "documents")
    return remove_repeats(docs, keep_text=False).drop("removed")


ORACLES["op1_substring_dedup"] = r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
p AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS win
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
f AS (SELECT win, min(doc_id) AS first_doc FROM p GROUP BY win HAVING min(doc_id) < max(doc_id)),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM p JOIN f USING (win) WHERE doc_id > first_doc),
x AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS j FROM w),
k AS (SELECT x.doc_id, string_agg(ws[x.j], ' ' ORDER BY x.j) AS kept, count(*) AS n
      FROM x LEFT JOIN g ON g.doc_id = x.doc_id AND g.j = x.j WHERE g.j IS NULL GROUP BY x.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""


def held_out(parts: int, part: int):
    """Whether crc32 of the doc_id as text leaves this remainder."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == part, F.lit(False))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score, train

    docs = table(spark, sf_dir, "documents")
    model = train(docs.filter(~held_out(4, 2)), table(spark, sf_dir, "labels"))
    scored = score(docs.withColumn("held_out", held_out(4, 2)), model, ("doc_id", "held_out"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import identify

    docs = table(spark, sf_dir, "documents")
    return identify(docs.withColumn("held_out", held_out(3, 1)), docs.filter(~held_out(3, 1)), ("doc_id", "held_out"))


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import decode, encode

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decode(encode(docs, path).drop("text"), path).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_report

    return mix_report(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op9_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5('mix:' || doc_id), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS total, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source),
c AS (SELECT *, [5, 2, 1][i % 3 + 1] AS weight, 3 * total AS cap, (3 * total) / [5, 2, 1][i % 3 + 1] AS fill FROM t),
l AS (SELECT *, (sum(total) OVER () - coalesce(sum(cap) OVER (ORDER BY fill, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(weight) OVER (ORDER BY fill, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM c),
v AS (SELECT min_by(level, fill) AS level FROM l WHERE level <= fill),
r AS (SELECT source, total, least(cap::DOUBLE, v.level * weight) AS target FROM l, v),
x AS (SELECT *, CASE WHEN total > 0 THEN target / total ELSE 0 END AS rate FROM r),
y AS (SELECT *, floor(rate) AS whole, rate - floor(rate) AS p, target - floor(rate) * total AS rest FROM x),
k AS (SELECT doc_id, size, total, target, whole, p, rest, d.source,
         CASE WHEN p > 0 THEN (u / (1.0 - u)) * ((1.0 - p) / p) END AS q
      FROM d JOIN y ON d.source IS NOT DISTINCT FROM y.source),
m AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY q, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 AS middle FROM k)
SELECT doc_id, size, total AS source_size, target,
       (size * (whole + CASE WHEN q IS NOT NULL AND middle <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM m
"""


PII_KEY = "example key; a job brings its own"


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import pseudonymize

    return pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


@query
def op4_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spot_signatures import fingerprints

    return fingerprints(table(spark, sf_dir, "documents"))


@query
def op8_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vector_search import search

    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


ORACLES["op2_minhash_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS id, doc_id AS root FROM w UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id AND r.root < e.b),
c AS (SELECT id, min(root) AS component_id FROM r GROUP BY id)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN c ON c.id = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id
"""


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score, train

    docs = table(spark, sf_dir, "documents")
    model = train(docs.filter(~held_out(5, 0)), table(spark, sf_dir, "labels"))
    scored = score(docs.withColumn("held_out", held_out(5, 0)), model, ("doc_id", "held_out"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the texts by crc32 of the doc_id repeats a passage from word a on, p words long."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = docs.filter("text IS NOT NULL").select(
        "doc_id", "text", h.alias("h"), g.alias("g"),
        F.explode(F.array(F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0)))).alias("words"),
    )
    n = F.size("words")
    turned = words.withColumn("a", F.when(n > 0, (F.col("g") % n).cast("int"))).withColumn(
        "p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)).cast("int")
    )
    a, p = F.col("a"), F.col("p")
    changed = F.transform("words", lambda w, i: F.when(i < a, w).otherwise(F.get("words", a + F.pmod(i - a, p))))
    text = F.when((F.col("h") % 10 == 0) & (n > 0), F.array_join(changed, " ")).otherwise(F.col("text"))
    return turned.select("doc_id", text.alias("text")).unionByName(docs.filter("text IS NULL").select("doc_id", "text"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .periodic_runs import collapse_runs, listed, longest

    found = collapse_runs(with_repeats(table(spark, sf_dir, "documents")))
    best = longest(F.col("runs"))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan

    place = F.col("places.place")
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"), F.array_min(place).alias("first_word"),
        F.array_max(place).alias("last_word"), F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score",
    )


def _license_sql() -> str:
    from .licenses import PHRASES, TEMPLATES, notices, words_in

    wanted = notices(TEMPLATES)
    kinds = ", ".join(f"({x.number}, '{x.label}', {len(x.words)}, {x.least}, {x.width})" for x in wanted)
    held = ", ".join(f"({x.number}, '{w}')" for x in wanted for w in x.words)

    def stands(words: list[str]) -> str:
        return " AND ".join(f"ws[i + {k}] = '{x}'" for k, x in enumerate(words))

    base = " UNION ALL ".join(
        f"SELECT doc_id, unnest(list_filter(range(1, len(ws) + 1), lambda i: {stands(words_in(phrase))})) - 1 AS place, '{label}' AS label FROM w"
        for phrase, label in PHRASES.items()
    )
    return rf"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
b AS ({base}),
t(number, label, words, least, width) AS (VALUES {kinds}),
h(number, word) AS (VALUES {held}),
o AS (SELECT width, doc_id, unnest(range(0, len(ws), width // 2)) AS s,
             unnest(list_transform(range(0, len(ws), width // 2), lambda s: ws[s + 1:s + width])) AS block
      FROM w, (SELECT DISTINCT width FROM t)),
k AS (SELECT DISTINCT width, doc_id, s, unnest(block) AS word FROM o),
c AS (SELECT doc_id, label, count(*) / any_value(words) AS containment
      FROM k JOIN h USING (word) JOIN t ON t.number = h.number AND t.width = k.width
      GROUP BY doc_id, s, t.number, label HAVING count(*) >= any_value(least)),
l AS (SELECT doc_id, label, 1.0::DOUBLE AS score FROM b UNION ALL SELECT doc_id, label, containment FROM c),
x AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score FROM l GROUP BY doc_id),
y AS (SELECT doc_id, count(*) AS n, min(place) AS first_word, max(place) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM w LEFT JOIN y USING (doc_id) LEFT JOIN x USING (doc_id)
"""


ORACLES["op12_license_scan"] = _license_sql()


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fill_in_middle import fill_in_middle, restore

    return restore(fill_in_middle(table(spark, sf_dir, "documents"))).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


ORACLES["op13_fill_in_middle"] = """
WITH h AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS d FROM documents),
c AS (SELECT doc_id, text, n, ('0x' || d[1:8])::BIGINT % (n + 1) AS x, ('0x' || d[9:16])::BIGINT % (n + 1) AS y,
             ('0x' || d[17:24])::BIGINT % 100 AS plain, ('0x' || d[25:32])::BIGINT % 100 AS spm FROM h),
f AS (SELECT doc_id, text, n, least(x, y) AS a, greatest(x, y) AS b,
             CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR plain >= 90 THEN 'plain'
                  WHEN spm < 20 THEN 'spm' ELSE 'psm' END AS form FROM c),
p AS (SELECT *, substring(text, 1, a) AS prefix, substring(text, a + 1, b - a) AS middle, substring(text, b + 1) AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form != 'plain' THEN a END AS prefix_chars, CASE WHEN form != 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
