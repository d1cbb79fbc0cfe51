"""Near duplicates: MinHash bands find candidates, odd sketches check them, full sets confirm them.

A document's set is its distinct sequences of WIDTH words (of A-Z lower-cased text); shorter ones
have their whole sequence. Documents are linked if the Jaccard coefficient of their sets is
``percent`` / 100 or more, and a document's component is the least id it reaches.

* Equal sets are one from the start: the one with the least id stands for them all.
* BANDS bands of ROWS minima each put sets into buckets. Two sets of 0.85 share one but for a chance
  of 2e-10.
* The minima of 1024 parts of the hash range are folded into a parity bitmap, the odd sketch. The
  bits in which two sketches differ tell how many minima differ, the more precisely the more alike
  the sets are. Pairs go on unless they are CERTAIN standard deviations below the wanted likeness.
* What goes on is counted on the full sets, which go once to each tile of pairs.

Links are looked for where they can still join something. First, each set is compared with one
member of each of its buckets (by random priority), and its best three are confirmed. Buckets that
then still hold several components are searched in full, in two rounds: the best partner in another
component for each set, and after these are joined all partners left. So every link between
components is tested, and no bucket's pairs are ever listed. The pairs of a member that stands for more than PIECE
sets are confirmed in pieces by several tasks, each with that member's set and its own others. A bucket with more than TILE sets is
searched in tiles by several tasks.

Defined cases: a document without words, or with null text, has an empty set and is linked with
nothing; a null doc_id is linked with nothing, has no component and is kept; rows of one doc_id are
linked by their texts like others, and each row has its set's component; extra columns stay unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from .components import components
from .packed import buckets, join_small, pack, ready, run_starts, stored, unpack
from .words import as_bytes, chunks, mix, sequence_codes, word_codes

WIDTH = 5
BANDS, ROWS = 30, 4
PARTS = 1024
SKETCH_BITS = 1024
CERTAIN = 5.0
TILE = 20_000
PIECE = 2_000

_rng = np.random.Generator(np.random.PCG64(85))
_TIMES = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _rng.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64)


def shingles(texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Text and code of every distinct shingle, ordered by both."""
    codes, at = word_codes([t.lower() for t in texts])
    count = np.diff(at)
    owner = np.repeat(np.arange(len(texts)), count)
    found = sequence_codes(codes, width, 11)
    whole = owner[: len(found)] == owner[width - 1 :] if len(found) else np.zeros(0, bool)
    rows, values = [owner[: len(found)][whole]], [found[whole]]
    for i in np.flatnonzero((count > 0) & (count < width)):
        rows.append(np.array([i]))
        values.append(sequence_codes(codes[at[i] : at[i + 1]], int(count[i]), 100 + int(count[i])))
    row, value = np.concatenate(rows), np.concatenate(values)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    first = run_starts(row, value)
    return row[first], value[first]


def band_keys(value: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """BANDS bucket keys for each run of shingle codes."""
    keys = np.zeros((len(starts), BANDS), np.uint64)
    for i in range(BANDS * ROWS):
        least = np.minimum.reduceat(value * _TIMES[i] + _PLUS[i], starts)
        keys[:, i // ROWS] = mix(keys[:, i // ROWS] + least + np.uint64(i))
    return keys


def odd_sketches(row: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Parity bitmaps of the least codes in 1024 parts of the hash range (codes in order), and how many parts have one."""
    part = value // np.uint64(2**64 // PARTS)
    first = run_starts(row, part)
    bit = (mix(value[first]) & np.uint64(SKETCH_BITS - 1)).astype(np.int64)
    held = np.bincount(row[first] * SKETCH_BITS + bit, minlength=rows * SKETCH_BITS) & 1
    return np.packbits(held.reshape(rows, SKETCH_BITS).astype(bool), axis=1), np.bincount(row[first], minlength=rows)


def estimate(different: np.ndarray, minima_a, minima_b) -> tuple[np.ndarray, np.ndarray]:
    """Likeness by the number of bits in which two sketches differ, and how far off that may be (CERTAIN deviations)."""
    m = SKETCH_BITS
    x = np.minimum(different / m, 0.499)
    apart = -m / 2 * np.log1p(-2 * x)
    equal = np.clip((minima_a + minima_b - apart) / 2, 0, np.minimum(minima_a, minima_b))
    only_a, only_b = minima_a - equal, minima_b - equal
    # Parts in which both have a minimum, but not the same.
    clash = (only_a * minima_b + only_b * minima_a) / (2 * PARTS)
    union = np.maximum(equal + only_a + only_b - clash, 1)
    full = 4 * apart / m
    bits = np.exp(full / 2) * np.sqrt(m / 4 * np.maximum(1 - np.exp(-full) * (1 + full), 0))
    # Sets with few codes for a part are in the sketch almost whole; others are sampled by their minima.
    left_out = 1 - union / np.maximum(-PARTS * np.log1p(-np.minimum(union / PARTS, 0.999)), 1)
    like = equal / union
    sampling = like * (1 - like) / union * np.maximum(left_out, 0.02)
    return like, CERTAIN * np.sqrt((0.8 * bits / union) ** 2 + sampling) + 0.01


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


_SET = "id bigint, rows_key bigint, n bigint, s1 bigint, s2 bigint, minima int, sketch binary, bands binary"


def _describe(docs: DataFrame, width: int) -> DataFrame:
    """For every row with a doc_id: doc_id, a hash of its text, its set's size, digest, sketch and bucket keys."""

    def run(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            texts = [as_bytes(t) for t in batch["text"]]
            for a, b in chunks(texts):
                row, value = shingles(texts[a:b], width)
                n = np.bincount(row, minlength=b - a)
                some = np.flatnonzero(n)
                starts = np.searchsorted(row, some)
                s1, s2 = np.zeros(b - a, np.uint64), np.zeros(b - a, np.uint64)
                keys = np.zeros((b - a, BANDS), np.uint64)
                if len(some):
                    s1[some] = np.add.reduceat(mix(value + np.uint64(1)), starts)
                    s2[some] = np.bitwise_xor.reduceat(mix(value + np.uint64(2)), starts)
                    keys[some] = band_keys(value, starts)
                sketch, minima = odd_sketches(row, value, b - a)
                yield pd.DataFrame(
                    {
                        "id": batch["id"].to_numpy()[a:b], "rows_key": batch["rows_key"].to_numpy()[a:b], "n": n,
                        "s1": s1.view(np.int64), "s2": s2.view(np.int64), "minima": minima.astype(np.int32),
                        "sketch": [x.tobytes() for x in sketch], "bands": [x.tobytes() for x in keys],
                    }
                )

    return _named(docs).mapInPandas(run, _SET)


def _named(docs: DataFrame) -> DataFrame:
    return docs.filter("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("id"), F.xxhash64("text").alias("rows_key"), F.col("text").cast("string").alias("text")
    )


def _bucket_rows(sets: DataFrame, *more: str) -> DataFrame:
    """A row for each set and band: key, id and the other columns."""

    def run(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            keys = np.frombuffer(b"".join(batch["bands"]), np.int64)
            out = {"key": keys, "id": np.repeat(batch["id"].to_numpy(), BANDS)}
            yield pd.DataFrame(out | {m: np.repeat(batch[m].to_numpy(), BANDS) for m in more})

    return sets.select("id", "bands", *more).mapInPandas(run, "key bigint, id bigint" + "".join(f", {m} bigint" for m in more))


def _with_sketches(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b with their estimated likeness, without those that are surely below ``percent``."""
    for side in ("a", "b"):
        own = sets.select(F.col("id").alias(side), F.struct("minima", "sketch").alias(f"s_{side}"))
        pairs = pairs.join(own, side)
    flat = pairs.select(
        "a", "b", *(F.col(f"s_{s}")[c].alias(f"{c}_{s}") for s in ("a", "b") for c in ("minima", "sketch"))
    )

    def run(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch[f"sketch_{s}"]), np.uint64).reshape(len(batch), -1) for s in ("a", "b"))
            like, off = estimate(popcount(x ^ y), batch["minima_a"].to_numpy(), batch["minima_b"].to_numpy())
            out = pd.DataFrame({"a": batch["a"], "b": batch["b"], "like": like})
            yield out[like + off >= percent / 100]

    return flat.mapInPandas(run, "a bigint, b bigint, like double")


def enough(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets of codes are alike enough, counted in full."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    both = np.concatenate((a, b))
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= percent * (small + large - shared)


_PAIRS = "tile bigint, cell binary"


def _packed(tile: int, pairs: np.ndarray) -> pd.DataFrame:
    """One row for a tile's distinct pairs, the smaller id of each first."""
    pairs = np.unique(np.sort(pairs, axis=1), axis=0)
    return pd.DataFrame({"tile": [tile], "cell": [pack(pairs[:, 0].copy(), pairs[:, 1].copy())]} if len(pairs) else {"tile": [], "cell": []})


def _confirmed(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The packed pairs whose full sets are alike enough: a, b. ``full``: id, cell.

    A tile's pairs are counted together, so a set goes once to each tile and not with every pair.
    """
    pairs = stored(pairs, "minhash-open")

    def ids(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            for tile, cell in zip(batch["tile"], batch["cell"]):
                found = np.unique(np.concatenate(unpack(cell, np.int64, np.int64)))
                yield pd.DataFrame({"in_tile": tile, "id": found})

    sets = pairs.mapInPandas(ids, "in_tile bigint, id bigint").join(full, "id").select("in_tile", "id", "cell")

    def count(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        held = {i: unpack(c, np.uint64)[0] for i, c in zip(own["id"], own["cell"])}
        out = []
        for cell in asked["cell"]:
            a, b = unpack(cell, np.int64, np.int64)
            keep = np.array([enough(held[x], held[y], percent) for x, y in zip(a.tolist(), b.tolist())], bool)
            out.append(pd.DataFrame({"a": a[keep], "b": b[keep]}))
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": []})

    return sets.groupBy("in_tile").cogroup(pairs.groupBy("tile")).applyInPandas(count, "a bigint, b bigint")


def _full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """Packed shingle codes of the sets named in ``wanted`` (id, rows_key)."""

    def run(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            texts = [as_bytes(t) for t in batch["text"]]
            for a, b in chunks(texts):
                row, value = shingles(texts[a:b], width)
                ends = np.searchsorted(row, np.arange(b - a), side="right")
                cells = [pack(value[s:e]) for s, e in zip([0, *ends], ends)]
                yield pd.DataFrame({"id": batch["id"].to_numpy()[a:b], "cell": cells})

    chosen = join_small(_named(docs), wanted, ["id", "rows_key"])
    return chosen.select("id", "text").mapInPandas(run, "id bigint, cell binary").groupBy("id").agg(F.first("cell").alias("cell"))


def _open_pairs(sets: DataFrame, labels: DataFrame, percent: int, best: bool) -> DataFrame:
    """Pairs of sets that share a bucket but not a component and look alike, packed by tile. ``best``: for each set and bucket the best one only."""
    parts = buckets(sets.sparkSession)
    labelled = sets.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    rows = _bucket_rows(labelled, "component")
    mixed = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size"))
    mixed = mixed.filter("lo != hi").select("key", F.ceil(F.col("size") / TILE).alias("tiles"))
    rows = rows.join(mixed, "key").join(sets.select("id", "minima", "sketch"), "id")
    mine = F.pmod(F.xxhash64("id"), F.col("tiles"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)))
    rows = rows.withColumn("cell", F.xxhash64("key", F.least(mine, F.col("other")), F.greatest(mine, F.col("other"))))
    rows = rows.withColumn("tile", F.pmod("cell", F.lit(parts))).select("tile", "cell", "id", "component", "minima", "sketch")

    def look(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["cell", "id"], kind="stable")
        sketch = np.frombuffer(b"".join(group["sketch"]), np.uint64).reshape(len(group), -1)
        cell, ids, part, minima = (group[c].to_numpy() for c in ("cell", "id", "component", "minima"))
        starts = run_starts(cell)
        out = []
        for s, e in zip(starts, np.append(starts[1:], len(cell))):
            names, at, size = np.unique(part[s:e], return_inverse=True, return_counts=True)
            # Only sets outside the largest component look for partners; its own find them from there.
            seekers = s + np.flatnonzero(at != size.argmax())
            step = max(1, 2_000_000 // (e - s))
            for i in range(0, len(seekers), step):
                q = seekers[i : i + step]
                like, off = estimate(popcount(sketch[q][:, None] ^ sketch[s:e][None]), minima[q][:, None], minima[s:e][None])
                like[like + off < percent / 100] = -1
                like[part[q][:, None] == part[s:e][None]] = -1
                if best:
                    x, y = np.arange(len(q)), like.argmax(axis=1)
                    good = like[x, y] >= 0
                    x, y = x[good], y[good]
                else:
                    x, y = np.nonzero(like >= 0)
                out.append(np.column_stack([ids[q[x]], ids[s + y]]))
        return _packed(int(group["tile"].iloc[0]), np.concatenate(out) if out else np.zeros((0, 2), np.int64))

    return rows.groupBy("tile").applyInPandas(look, _PAIRS)


def _dealt(ranked: DataFrame) -> DataFrame:
    """Pairs a, b with their tile: those of one b together, or in pieces of about PIECE by a."""
    many = ranked.groupBy("b").agg(F.ceil(F.count("*") / PIECE).alias("pieces")).filter("pieces > 1")
    pieces = F.coalesce("pieces", F.lit(1).cast("bigint"))
    tile = F.pmod(F.xxhash64("b", F.pmod(F.xxhash64("a"), pieces)), F.lit(buckets(ranked.sparkSession)))
    return join_small(ranked, many, "b", "left").select(tile.alias("tile"), "a", "b")


def near_duplicates(docs: DataFrame, percent: int = 85, width: int = WIDTH) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, kept, rows_key (xxhash64 of the text)."""
    ready(docs.sparkSession)
    described = stored(_describe(docs, width), "minhash")
    digest = ["n", "s1", "s2"]
    one = F.min(F.struct("id", "rows_key", "minima", "sketch", "bands")).alias("x")
    sets = described.filter("n > 0").groupBy(*digest).agg(one).select(*digest, "x.*")
    sets = stored(sets, "minhash-sets")

    rows = _bucket_rows(sets)
    priority = F.struct(F.xxhash64("key", "id").alias("p"), F.col("id").alias("b"))
    centers = rows.groupBy("key").agg(F.min(priority)["b"].alias("b"), F.count("*").alias("size")).filter("size > 1")
    together = stored(rows.join(centers, "key").select(F.col("id").alias("a"), "b").distinct(), "minhash-pairs")
    members = together.select(F.col("a").alias("id")).union(together.select(F.col("b").alias("id"))).distinct()
    full = stored(_full_sets(docs, sets.join(members, "id").select("id", "rows_key"), width), "minhash-full")

    alike = _with_sketches(together.filter("a != b"), sets, percent)
    ranked = alike.withColumn("i", F.row_number().over(W.partitionBy("a").orderBy(F.desc("like"), "b"))).filter("i <= 3")
    ranked = stored(ranked.select("a", "b"), "minhash-ranked")
    first = _dealt(ranked).groupBy("tile").applyInPandas(lambda g: _packed(int(g["tile"].iloc[0]), g[["a", "b"]].to_numpy()), _PAIRS)
    links = stored(_confirmed(first, full, percent), "minhash-links")
    labels = components(links)
    for best in (True, False):
        more = _confirmed(_open_pairs(sets, labels, percent, best), full, percent)
        links = stored(links.union(more), "minhash-links")
        labels = components(links)

    named = sets.join(labels, "id", "left").select(*digest, F.coalesce("component", "id").alias("component_id"))
    found = described.join(named, digest, "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"), "rows_key"
    )
    found = found.withColumn("kept", F.col("doc_id") == F.col("component_id"))
    nameless = docs.filter("doc_id IS NULL").select(F.col("text").cast("string").alias("text"))

    def sizes(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            texts = [as_bytes(t) for t in batch["text"]]
            for a, b in chunks(texts):
                yield pd.DataFrame({"n_shingles": np.bincount(shingles(texts[a:b], width)[0], minlength=b - a)})

    nameless = nameless.mapInPandas(sizes, "n_shingles bigint").withColumn("kept", F.lit(True))
    return found.unionByName(nameless, allowMissingColumns=True)
