"""Repeated passages and near copies against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from helpers_llm import frame, words
from signalmill.llm import minhash_dedup, packed, substring_dedup
from signalmill.llm.components import components


def split(text):
    return [] if text is None else text.encode().split()


def removed_by_hand(rows, n):
    first = {}
    for doc, text, *_ in rows:
        w = split(text)
        for i in range(len(w) - n + 1) if doc is not None else ():
            key = tuple(w[i : i + n])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text, *_ in rows:
        w = split(text)
        gone = set()
        for i in range(len(w) - n + 1) if doc is not None else ():
            if first[tuple(w[i : i + n])] < doc:
                gone |= set(range(i, i + n))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("n", [4, 13])
def test_repeats_match_brute_force(spark, awkward_rows, n):
    rng = random.Random(n)
    rows = awkward_rows + [(100 + i, words(rng, rng.randrange(80), 3 if i % 2 else 60), "en", "a") for i in range(60)]
    out = substring_dedup.remove_repeats(frame(spark, rows), n)
    assert found(out, "doc_id", "n_words", "n_removed", "kept_sha256") == removed_by_hand(rows, n)
    for r in out.collect():
        assert sum(s["words"] for s in r["removed"]) == r["n_removed"]
        assert hashlib.sha256(r["text"].encode()).hexdigest() == r["kept_sha256"]


def test_no_rows(nothing):
    assert substring_dedup.remove_repeats(nothing).count() == 0
    assert minhash_dedup.near_duplicates(nothing).count() == 0


def components_by_hand(rows, percent):
    sets, members = [], []
    for doc, text, *_ in rows:
        w = [bytes(x) for x in split(None if text is None else text.encode().lower().decode())]
        sets.append({tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if None in (rows[i][0], rows[j][0]) or not both:
                continue
            if 100 * both >= percent * len(sets[i] | sets[j]):
                group[root(i)] = root(j)
    least = defaultdict(lambda: 10**9)
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least[root(i)], r[0])
    for i, r in enumerate(rows):
        c = None if r[0] is None else least[root(i)]
        members.append((r[0], len(sets[i]), c, c == r[0]))
    return sorted(members, key=str)


@pytest.mark.parametrize("tile", [3, 20_000])
def test_components_match_brute_force(spark, awkward_rows, tile, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "TILE", tile)
    rng = random.Random(3)
    base = words(rng, 150, 4000).split()
    rows = [r for r in awkward_rows if r[0] not in (1, 2, None)] + [(0, words(rng, 60), "en", "a")]
    for i in range(90):  # copies with up to six changed words: many just above and below the limit
        copy = list(base)
        for _ in range(rng.randrange(7)):
            copy[rng.randrange(len(copy))] = f"n{rng.randrange(10**6)}"
        rows.append((200 + i, " ".join(copy), "en", "a"))
    out = minhash_dedup.near_duplicates(frame(spark, rows))
    assert found(out, "doc_id", "n_shingles", "component_id", "kept") == components_by_hand(rows, 85)


def test_a_large_group_is_confirmed_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "PIECE", 4, raising=False)
    confirmed, most = minhash_dedup._confirmed, []

    def watched(pairs, full, percent):
        most.append(sorted(sum(len(packed.unpack(r["cell"], np.int64)[0]) for r in rows) for rows in by_tile(pairs)))
        return confirmed(pairs, full, percent)

    def by_tile(pairs):
        tiles = defaultdict(list)
        for r in pairs.collect():
            tiles[r["tile"]].append(r)
        return tiles.values()

    monkeypatch.setattr(minhash_dedup, "_confirmed", watched)
    rng = random.Random(8)
    base, rows = words(rng, 150, 4000).split(), []
    for i in range(200):  # each another text, all alike
        copy = list(base)
        copy[rng.randrange(len(copy))] = f"n{i}"
        rows.append((i, " ".join(copy), "en", "a"))
    out = minhash_dedup.near_duplicates(frame(spark, rows))
    assert found(out, "doc_id", "n_shingles", "component_id", "kept") == components_by_hand(rows, 85)
    assert sum(most[0]) > 200 and most[0][-1] < sum(most[0]) / 4, most[0]


def test_null_ids_and_repeated_rows(awkward, awkward_rows):
    rows = minhash_dedup.near_duplicates(awkward).collect()
    assert len(rows) == len(awkward_rows)
    assert all(r["kept"] and r["component_id"] is None for r in rows if r["doc_id"] is None)
    assert all(r["component_id"] == 1 for r in rows if r["doc_id"] == 1)
    assert {r["component_id"] for r in rows if r["doc_id"] in (5, 6)} == {5}
    assert {r["component_id"] for r in rows if r["doc_id"] in (8, 10, 11)} == {8}
    assert [r["n_shingles"] for r in rows if r["doc_id"] in (3, 4, 7)] == [0, 0, 0]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 200), (301, 300), (301, 302)]
    out = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert {out[i] for i in range(41)} == {0} and {out[100 + i] for i in range(50)} == {100} and out[302] == 300
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
