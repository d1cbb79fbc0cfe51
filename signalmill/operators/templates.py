"""Templates of log bodies, and search in them by an inverted token table.

A body is its words between white space; a word with a digit is a variable, written ``<*>``. Bodies of one number
of words are put into a prefix tree: at each of the first DEPTH words a node has a branch for each word, but a
node with more than BRANCHES words has one branch, ``<*>``, for all. Below, at the leaves, a place with more than
one word is ``<*>`` too. The way to a leaf with its places is the template.

The tree depends on the set of bodies alone, not on their order, so tasks reduce their bodies to masked ones
with counts, and only those are shuffled and branched, one level of the tree a step. Defined cases: a null body
has no template; an empty one, or one of white space only, has the empty template.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

VARIABLE = "<*>"
DEPTH = 3
BRANCHES = 20


def body_words(body: Column) -> Column:
    return F.array_remove(F.split(body, r"\s+"), "")


def masked(body: Column) -> Column:
    """The words of a body with ``<*>`` in place of those with a digit."""
    return F.transform(body_words(body), lambda w: F.when(w.rlike(r"[0-9]"), F.lit(VARIABLE)).otherwise(w))


def _kept(words: Column, place: int, keep: Column) -> Column:
    """Words with ``<*>`` at a place unless it is kept."""
    return F.transform(words, lambda w, i: F.when((i == place) & ~keep, F.lit(VARIABLE)).otherwise(w))


def template_map(logs: DataFrame, body: str = "body", depth: int = DEPTH, branches: int = BRANCHES) -> DataFrame:
    """Every masked body with its template and count: masked, template (arrays of words), log_count."""
    patterns = logs.filter(F.col(body).isNotNull()).groupBy(masked(F.col(body)).alias("masked")).agg(F.count("*").alias("log_count"))
    tree = patterns.select("masked", "log_count", F.size("masked").alias("length"), F.col("masked").alias("way"))
    for place in range(depth):
        word = F.get("way", F.lit(place))
        each = tree.select("length", F.slice("way", 1, place).alias("node"), word.alias("word")).distinct()
        wide = each.groupBy("length", "node").agg(F.count("word").alias("words")).filter(F.col("words") > branches)
        wide = wide.select(F.struct("length", "node").alias("_node"), F.lit(False).alias("_keep"))
        tree = tree.withColumn("_node", F.struct("length", F.slice("way", 1, place).alias("node"))).join(wide, "_node", "left")
        tree = tree.withColumn("way", _kept(F.col("way"), place, F.coalesce("_keep", F.lit(True)))).drop("_node", "_keep")
    leaf = F.struct("length", F.slice("way", 1, depth).alias("head")).alias("_leaf")
    placed = tree.select(leaf, F.posexplode("way").alias("place", "word")).filter(F.col("place") >= depth)
    varied = placed.distinct().groupBy("_leaf", "place").agg(F.count("*").alias("words")).filter("words > 1")
    varied = varied.groupBy("_leaf").agg(F.collect_set("place").alias("varied"))  # places of one length
    joined = tree.withColumn("_leaf", F.struct("length", F.slice("way", 1, depth).alias("head"))).join(varied, "_leaf", "left")
    template = F.transform(
        "way", lambda w, i: F.when(F.coalesce(F.array_contains(F.col("varied"), i), F.lit(False)), F.lit(VARIABLE)).otherwise(w)
    )
    return joined.select("masked", template.alias("template"), "log_count")


def log_templates(logs: DataFrame, body: str = "body", depth: int = DEPTH, branches: int = BRANCHES) -> DataFrame:
    """template (text), log_count and body_kinds (masked bodies) of every template."""
    found = template_map(logs, body, depth, branches).groupBy(F.array_join("template", " ").alias("template"))
    return found.agg(F.sum("log_count").alias("log_count"), F.count("*").alias("body_kinds"))


def with_template(logs: DataFrame, templates: DataFrame, body: str = "body") -> DataFrame:
    """Logs with the template of their body, from a ``template_map``; null where it has none."""
    known = templates.select(F.col("masked").alias("_masked"), F.array_join("template", " ").alias("template"))
    return logs.withColumn("_masked", masked(F.col(body))).join(known, "_masked", "left").drop("_masked")


# --- search


def terms_of(body: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(body), r"[^\p{L}\p{N}]+"), "")


def postings(logs: DataFrame, keep: list[str], body: str = "body") -> DataFrame:
    """A row for each term of each log: term and the columns to keep, which tell logs apart.

    Written by ``rewrite_clustered(..., ["term"])`` a search reads the row groups of its terms alone, and a
    term that fills many files is cut into several.
    """
    kept = [F.col(c) for c in keep]
    return logs.select(F.explode(F.array_distinct(terms_of(F.col(body)))).alias("term"), *kept)


def search(posted: DataFrame, terms: list[str], keep: list[str]) -> DataFrame:
    """The kept columns of logs that hold all terms; nothing but their postings is read."""
    wanted = sorted({t.lower() for t in terms})
    if not wanted:
        raise ValueError("a search needs a term")
    hits = posted.filter(F.col("term").isin(wanted))
    held = hits.groupBy(*keep).agg(F.count_distinct("term").alias("_terms"))
    return held.filter(F.col("_terms") == len(wanted)).drop("_terms")
