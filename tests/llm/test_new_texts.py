"""Periodic runs, license notices and fill-in-the-middle examples against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from helpers_llm import frame, words
from pyspark.sql import functions as F

from signalmill.llm import catalog, fill_in_middle as fim, licenses, periodic_runs as runs

SF_DIR = "/root/testdata/sf0.001"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def split(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# --- periodic runs


def runs_by_hand(w: list, length: int, repeats: int) -> list[tuple[int, int, int]]:
    """Every maximal stretch of every period; of equal stretches the smallest period."""
    best: dict[tuple[int, int], int] = {}
    for q in range(1, len(w) // repeats + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - start >= max(length, repeats * q):
                best.setdefault((start, i + q), q)
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def collapsed_by_hand(w: list, found) -> str:
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def texts_with_runs(rng: random.Random, many: int) -> list[str]:
    out = []
    for _ in range(many):
        parts = []
        for _ in range(rng.randrange(1, 7)):
            base = words(rng, rng.randrange(1, 9), rng.choice([1, 2, 3, 50])).split()
            long = base * rng.randrange(1, 9)
            parts += long[: len(long) - rng.randrange(len(base))]
        out.append(" ".join(parts))
    return out


@pytest.mark.parametrize("length, repeats", [(6, 4), (2, 2), (5, 3)])
def test_runs_match_brute_force(length, repeats):
    rng = random.Random(length)
    for text in texts_with_runs(rng, 1500):
        w = text.split()
        found = runs.periodic_runs(runs.numbered([x.encode() for x in w]), length, repeats)
        assert found == runs_by_hand(w, length, repeats), text


def test_large_periods_in_long_words():
    rng = np.random.default_rng(3)
    for period, n in ((700, 2900), (65, 1000), (33, 140), (1024, 4096)):
        w = np.concatenate([rng.integers(0, 40, 50), np.resize(rng.integers(0, 9, period), n), rng.integers(0, 40, 77)])
        assert runs.lag_scan(w) == runs_by_hand(w.tolist(), 6, 4) and any(r[2] == period for r in runs.lag_scan(w))
    assert runs.lag_scan(np.tile([0, 0, 1], 1500)) == runs_by_hand([0, 0, 1] * 1500, 6, 4)


def test_one_word_over_and_over_takes_no_square():
    assert runs.periodic_runs(np.zeros(3_000_000, np.int64)) == [(0, 3_000_000, 1)]


def test_splitting_keeps_what_runs_need():
    w = np.array([1, 2, 1, 2, 1, 2, 1, 2, 9, 1, 2, 1, 2, 3, 3, 3, 3, 3, 3])
    assert runs.frequent_segments(w) == [(0, 8), (13, 19)]
    assert runs.frequent_segments(np.arange(100)) == [] == runs.frequent_segments(np.zeros(0, np.int64))


def test_runs_of_awkward_and_no_rows(spark, awkward, awkward_rows, nothing):
    assert runs.collapse_runs(nothing).count() == 0
    got = rows_of(runs.collapse_runs(awkward, ("doc_id", "id", "score")), "doc_id", "n_words", "runs", "collapsed", "id", "score")
    want = []
    for doc, text, *_ in awkward_rows:
        w = split(text)
        found = runs_by_hand(w, 6, 4) if len(w) < 1000 else []
        want.append((doc, len(w), [tuple(x) for x in found], collapsed_by_hand(w, found), 7, "x"))
    assert [(a, b, [tuple(x) for x in c], *d) for a, b, c, *d in got] == sorted(want, key=str)


def test_query_of_runs_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for doc, text in docs:
        w, h = split(text), zlib.crc32(str(doc).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else x for i, x in enumerate(w)]
        found = runs_by_hand(w, 6, 4)
        best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
        listed = "".join(f"{s},{k},{q}\n" for s, k, q in found)
        want.append((doc, len(found), *best, 1000 * best[1] // best[2] if found else None, sha(listed), sha(collapsed_by_hand(w, found))))
    got = catalog.op11_periodic_runs(spark, SF_DIR)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert rows_of(got, *got.columns) == sorted(want, key=str) and any(r[1] for r in want)


# --- licenses


def scanned_by_hand(text: str | None, templates, phrases, threshold: float):
    w = licenses.words_in(text or "")
    places = [(i, label) for p, label in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    blocks = []
    for x in licenses.notices(templates, threshold):
        kinds = set(x.words)
        for s in range(0, len(w), x.width // 2):
            shared = len(kinds & set(w[s : s + x.width]))
            if shared >= threshold * len(kinds) - 1e-9:
                blocks.append((x.number, x.label, s, shared, shared / len(kinds)))
    labels = sorted({label for _, label in places} | {b[1] for b in blocks})
    score = 1.0 if places else max((b[4] for b in blocks), default=0.0)
    return len(w), sorted(places), sorted(blocks), sorted({label for _, label in places}), labels, score


def scan_rows(df, **options):
    found = licenses.scan(df, **options).select("doc_id", "n_words", "places", "blocks", "base_labels", "labels", "score").collect()
    return sorted(((r[0], r[1], sorted(map(tuple, r[2])), sorted(map(tuple, r[3])), r[4], r[5], r[6]) for r in found), key=str)


def license_rows(rng: random.Random, many: int):
    pool = [t for _, t in licenses.TEMPLATES] + list(licenses.PHRASES)
    rows = []
    for i in range(many):
        parts = []
        for _ in range(rng.randrange(4)):
            parts.append(words(rng, rng.randrange(40), 30))
            w = rng.choice(pool).split()
            drop = rng.choice([0, 0, 0.1, 0.25, 0.4])
            w = [x.upper() if rng.random() < 0.2 else x for x in w if rng.random() >= drop]
            if rng.random() < 0.2:
                rng.shuffle(w)
            parts.append(rng.choice([" ", "\n", "-", "_", " é "]).join(w))
        rows.append((i, rng.choice(["", "É ", "İ ’ "]) + " ".join(parts), "en", "a"))
    return rows


@pytest.mark.parametrize("threshold", [0.8, 0.5, 1.0])
def test_notices_match_brute_force(spark, awkward_rows, threshold):
    rows = license_rows(random.Random(1), 150) + awkward_rows + [(901, "GNU General\tPublic-License", "en", "a"), (902, "gnu", "en", "a")]
    want = sorted(((r[0], *scanned_by_hand(r[1], licenses.TEMPLATES, licenses.PHRASES, threshold)) for r in rows), key=str)
    assert scan_rows(frame(spark, rows), threshold=threshold) == want
    assert any(r[3] for r in want)


def test_scan_of_other_notices_and_no_rows(spark, nothing):
    assert licenses.scan(nothing).count() == 0
    rows = [(1, "some own notice of ours", "en", "a"), (2, "own words", "en", "a")]
    got = scan_rows(frame(spark, rows), templates=[("ours", "Some own notice, of ours"), ("none", "...")], phrases={"own words": "own", "!": "none"})
    assert [(r[0], r[5], r[6]) for r in got] == [(1, ["ours"], 1.0), (2, ["own"], 1.0)]
    got = scan_rows(frame(spark, rows), templates=[], phrases={})
    assert [(r[0], r[1], r[5], r[6]) for r in got] == [(1, 5, [], 0.0), (2, 2, [], 0.0)]
    with pytest.raises(ValueError):
        licenses.scan(nothing, threshold=0)


def test_small_letters_are_those_of_a_to_z(spark):
    rows = [(1, "ÉÀ ABC Äb", "de", "a"), (2, "İAB ᲉA Ⓐ’S", "de", "a"), (3, "日本 ABC", "ja", "a")]
    w = frame(spark, rows).select("doc_id", licenses.words_of(F.col("text")).alias("w"))
    assert {r[0]: r[1] for r in w.collect()} == {i: licenses.words_in(t) for i, t, *_ in rows}


def test_scan_stays_in_sql(spark, awkward):
    plan = licenses.scan(awkward)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange", "Join"))


# --- fill in the middle


def example_by_hand(doc, text, seed="1"):
    text = text or ""
    d = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(d[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:low], text[low:high], text[high:]
    if h[3] % 100 < 20:
        return n, "spm", low, high - low, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", low, high - low, f"<P>{p}<S>{s}<M>{m}"


def texts_with_wide_characters(rng: random.Random, many: int):
    letters = "ab <PSM>é漢🙂\n\t"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randrange(30))), "en", "a") for i in range(many)]
    return rows + [(many + i, t, "en", "a") for i, t in enumerate(["<P>", "<P", "S>", "x<M>", "é" * 4000 + "a" * 4000 + "🙂" * 4000])]


def test_examples_match_brute_force(spark, awkward_rows):
    rows = texts_with_wide_characters(random.Random(8), 600) + awkward_rows
    out = fim.restore(fim.fill_in_middle(frame(spark, rows), ("doc_id", "id", "form")))
    assert out.columns == ["doc_id", "id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    want = sorted(((r[0], *example_by_hand(r[0], r[1]), r[1] or "") for r in rows), key=str)
    got = rows_of(out.drop("id"), "doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored")
    assert got == want and {r[2] for r in want} == {"plain", "psm", "spm"}


def test_examples_of_other_seeds_and_no_rows(spark, awkward, nothing):
    assert fim.fill_in_middle(nothing).count() == 0
    all_plain = fim.fill_in_middle(awkward, plain_percent=100)
    assert {r["form"] for r in all_plain.collect()} == {"plain"}
    spm = fim.fill_in_middle(awkward, seed="2", plain_percent=0, spm_percent=100)
    assert {r["form"] for r in spm.collect()} == {"plain", "spm"}


def test_index_records_wide_characters_only():
    text = "aé漢b🙂c" * 50
    data = np.frombuffer(text.encode(), np.uint8)
    index = fim.CutIndex(data)
    assert len(index.places) == 150
    cuts = np.arange(len(text) + 1)
    want = np.array([len(text[:i].encode()) for i in cuts])
    assert (index.places_at(cuts) == want).all() and (index.points_at(want) == cuts).all()


@pytest.mark.parametrize("name", ["op12_license_scan", "op13_fill_in_middle"])
def test_queries_match_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    got = catalog.QUERIES[name](spark, SF_DIR)
    cur = con.execute(catalog.ORACLES[name])
    names = [c[0] for c in cur.description]
    assert got.columns == names
    assert rows_of(got, *names) == sorted(cur.fetchall(), key=str)


def test_kept_columns_may_have_dots(spark):
    docs = spark.createDataFrame([(1, "a a a a a a b", 5)], "doc_id bigint, text string, `a.b` int")
    for found in (runs.collapse_runs(docs, ("doc_id", "a.b")), licenses.scan(docs, ("doc_id", "a.b")), fim.fill_in_middle(docs, ("doc_id", "a.b"))):
        assert found.columns[:2] == ["doc_id", "a.b"] and [r["a.b"] for r in found.collect()] == [5]
    assert runs.collapse_runs(docs, ()).collect()[0]["collapsed"] == "a b"
