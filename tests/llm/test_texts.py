"""Fingerprints, pseudonyms, tokens and mixes."""

from __future__ import annotations

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from helpers_llm import frame, words
from signalmill.llm import bpe, catalog, mixing, pii, spot_signatures as spots

SF_DIR = "/root/testdata/sf0.001"


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


# --- fingerprints


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_follow_the_order_of_ids(spark, awkward_rows):
    rng = random.Random(2)
    rows = awkward_rows + [(1000 + i, words(rng, 30) + " the " + words(rng, 30), "en", "a") for i in range(50)]
    got = spots.fingerprints(frame(spark, rows)).toPandas()
    ordered = sorted(((-(2**63) if r[0] is None else r[0], r[1] or "") for r in rows))
    want = []
    for i, (doc, text) in enumerate(ordered):
        after = ordered[(i + 1) % len(ordered)][1]
        n = len(text) // 4
        changed = text[: len(text) - n] + after[:n]
        mine, new, other = (set(x.tolist()) for x in spots.signatures([t.encode() for t in (text, changed, after)]))
        want.append((None if doc < 0 else doc, len(text), sha(changed.encode()), round(jaccard(mine, new), 9), round(jaccard(mine, other), 9)))
    got = [
        (None if r.doc_id is None or r.doc_id != r.doc_id or str(r.doc_id) == "<NA>" else int(r.doc_id), r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9))
        for r in got.itertuples()
    ]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_equal_texts_have_equal_fingerprints_and_others_rarely(spark):
    rng = random.Random(5)
    texts = [words(rng, n, 9) for n in range(60)] * 2
    got = spots.fingerprints(frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])).orderBy("doc_id").collect()
    by = {}
    for t, r in zip(texts, got):
        by.setdefault(t, set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in by.values()) and len({x for v in by.values() for x in v}) == len(by)


def test_one_row_follows_itself(spark, nothing):
    row = spots.fingerprints(frame(spark, [(5, "abcdefgh", "en", "a")])).first()
    assert row["edited_sha256"] == sha(b"abcdefab") and row["near_next"] == 1.0
    assert spots.fingerprints(nothing).count() == 0


def test_chains_by_hand():
    common = {w for v in spots.ANTECEDENTS.values() for w in v.split()}
    text = "The cat of a dog ran for red, hot sun; by then it is gone"
    w = "".join(c.lower() if c.isalpha() else " " for c in text).split()
    chains = set()
    for i, x in enumerate(w):
        after = [y for y in w[i + 1 :] if y not in common]
        if x in common and len(after) >= spots.CHAIN:
            chains.add((x, *after[: spots.CHAIN]))
    assert len(spots.signatures([text.encode()])[0]) == len(chains)


def test_pruned_likeness_and_length_parts():
    a, b = (spots.signatures([t.encode()])[0] for t in ("the x y z the q r s", "the x y z"))
    assert spots.likeness(a, b) == len(set(a) & set(b)) / len(set(a) | set(b)) and spots.likeness(a, b, 0.9) == 0.0
    for small in range(1, 200):
        for large in range(small, int(small / 0.8) + 1):
            assert abs(spots.length_part(small, 0.8) - spots.length_part(large, 0.8)) <= 1
    assert (spots.read_fingerprint(spots.fingerprint(a)) == a).all()


# --- pseudonyms


def luhn(number: str) -> bool:
    digits = [int(c) for c in reversed(number) if c.isdigit()]
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def changed(spark, *texts):
    rows = pii.pseudonymize(frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]), "k").orderBy("doc_id").collect()
    return [(r["text"], r["pii_found"], r["pii_changed"]) for r in rows]


def test_formats_stay_and_values_go(spark):
    import re

    shapes = {
        "card 4111111111111111.": r"card \d{16}\.", "card 4111 1111 1111 1111": r"card \d{4} \d{4} \d{4} \d{4}",
        "on 2020-02-29 at": r"on \d{4}-\d\d-\d\d at", "on 29.02.2020, ok": r"on \d\d\.\d\d\.\d{4}, ok",
        "+1 (309) 555-7741!": r"\+1 \(\d{3}\) \d{3}-\d{4}!", "ip 97.51.17.173.": r"ip \d{1,3}(\.\d{1,3}){3}\.",
        "ssn 123-45-6789": r"ssn \d{3}-\d\d-\d{4}", "m ab.72@mail3.example.com": r"m [a-z]{2}\.\d\d@mail3\.example\.com",
        'token = "08813ad77930c5f691325605b62c9dfd1b407297"': r'token = "[0-9a-f]{40}"',
    }
    for (text, found, n), (source, shape) in zip(changed(spark, *shapes), shapes.items()):
        assert re.fullmatch(shape, text) and text != source and (found, n) == (1, 1), (source, text)
        if "card" in text:
            assert luhn(text)


def test_what_is_not_valid_stays(spark):
    texts = ["4111111111111112", "on 2021-02-30", "300.1.1.1 and 1.2.3.4.5", "000-12-3456", "license 4.0, 12345", "", None, "plain text"]
    assert [t for t, _, _ in changed(spark, *texts)] == texts
    assert all(n == 0 for _, _, n in changed(spark, *texts))


def test_equal_values_stay_linked_and_keys_differ(spark):
    texts = ["a 4111111111111111", "b 4111111111111111 c 4111-1111-1111-1111", "2020-02-29 x 2020-02-29"]
    (a, _, _), (b, _, n), (c, _, _) = changed(spark, *texts)
    number = a.split()[1]
    assert b.split()[1] == number and b.split()[3].replace("-", "") == number and n == 2 and c.split()[0] == c.split()[2]
    other = pii.pseudonymize(frame(spark, [(0, texts[0], "en", "a")]), "another").first()["text"]
    assert other != a


def test_values_beside_other_numbers(spark):
    phone, card, address = "+1 (826) 555-4081", "4111 1111 1111 1111", "190.137.223.204"
    (p, _, _), (c, _, _), (a, _, _) = changed(spark, phone, card, address)
    assert len({p, c, a, phone, card, address}) == 6
    flat = p.translate(str.maketrans("", "", " ()-"))
    expected = {
        f"{phone} {address}": (f"{p} {a}", 2), f"{phone} 2024": (f"{p} 2024", 1), f"{phone} 17 x": (f"{p} 17 x", 1),
        f"{phone} {card}": (f"{p} {c}", 2), "+18265554081": (flat, 1), "+18265554081 2024": (f"{flat} 2024", 1),
        "+1826-555-4081": (f"{flat[:5]}-{flat[5:8]}-{flat[8:]}", 1),
        f"{card} 123": (f"{c} 123", 1), f"12 {card}": (f"12 {c}", 1), f"12 {card} 345 6": (f"12 {c} 345 6", 1),
        f"1234567 {card}": (f"1234567 {c}", 1), f"{card} {card}": (f"{c} {c}", 2), f"{card} {address}": (f"{c} {a}", 2),
        f"{card.replace(' ', '')} 123": (f"{c.replace(' ', '')} 123", 1), f"12 {' '.join(card.replace(' ', ''))}": (f"12 {' '.join(c.replace(' ', ''))}", 1),
        f"12 {card[:-1]}2 345": (f"12 {card[:-1]}2 345", 0),
    }
    for (text, found, n), (source, (new, m)) in zip(changed(spark, *expected), expected.items()):
        assert (text, n) == (new, m) and found >= n, source


def test_phones_of_other_countries(spark):
    texts = ["+49 (30) 123-4567 2024", "+49 (30) 123-4567", "+44 20 7946 0958 17", "+442079460958", "+49-30-1234 5678", "+33 1 23 45 67 89"]
    (a, _, n), (b, _, _), (c, _, _), (d, _, _), (e, _, k), (f, _, m) = changed(spark, *texts)
    assert a == b + " 2024" and c.endswith(" 17") and c[:-3].replace(" ", "") == d and (n, k, m) == (1, 1, 1)
    assert e != texts[4] and e[:4] == "+49-" and f[:4] == "+33 " and f != texts[5]


def test_values_without_two_digits_in_a_row_are_searched(spark):
    card, key = "4-1-1-1-1-1-1-1-1-1-1-1-1-1-1-1", "abcdef" * 6
    texts = ["ping 8.8.8.8 now", "ping 8.8.8.8 now in 2024", card, f"{card} in 2024", f'k = "{key}"', f'k = "{key}" in 2024']
    got = changed(spark, *texts)
    for (alone, _, n), (beside, _, _), source in zip(got[::2], got[1::2], texts[::2]):
        assert alone != source and n == 1 and beside == alone + " in 2024"


def test_permutations_are_one_to_one(spark):
    days = spark.range(pii.BLOCK_DAYS).select(pii.permute_number(F.col("id"), "k", pii.BLOCK_PARTS).alias("v"))
    assert days.distinct().count() == pii.BLOCK_DAYS and days.agg(F.max("v")).first()[0] == pii.BLOCK_DAYS - 1
    for n in (1, 3, 4):
        digits = spark.range(10**n).select(pii.permute(F.lpad(F.col("id").cast("string"), n, "0"), "k").alias("v"))
        assert digits.distinct().count() == 10**n and digits.filter(F.length("v") != n).count() == 0


def test_rows_and_columns_of_pseudonyms(awkward, nothing):
    out = pii.pseudonymize(awkward, "k")
    assert out.columns == [*awkward.columns, "pii_found", "pii_changed"] and out.count() == awkward.count()
    same = out.select(*awkward.columns).exceptAll(awkward)
    assert same.count() == 0 and pii.pseudonymize(nothing, "k").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


# --- tokens


def path():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def strange_texts():
    rng = random.Random(5)
    pool = [*" \n\t\r\x0b\x1c\x85\xa0　'sStTveREdm", "'ll", "<|endoftext|>", "<|endof", "é", "日本", "🙂", "́", "½", " the", "12", "!?", "\x00"]
    return ["".join(rng.choices(pool, k=rng.randrange(25))) for _ in range(3000)] + ["ab" * 4000, " " * 999, "x" * 5000]


def test_tokens_match_the_library(spark):
    from tokenizers import Tokenizer

    library, encoder = Tokenizer.from_file(path()), bpe.Encoder(bpe.Vocabulary.load(path()))
    texts = strange_texts()
    mine = [x.tolist() for x in encoder.encode(texts)]
    assert mine == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    for ids in mine[::7]:
        for part in (ids, ids[1:-1]):
            assert bpe.decode_ids(part, encoder.v.id_bytes) == library.decode(part, skip_special_tokens=False)


def test_tokens_of_rows(spark, awkward, awkward_rows, nothing):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path())
    rows = bpe.decode(bpe.encode(awkward, path()), path()).collect()
    assert len(rows) == len(awkward_rows) and bpe.encode(nothing, path()).count() == 0
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["decoded"] == (r["text"] or "") and r["home"] == "x"


def test_decoding_of_strange_ids(spark):
    rows = [(1, [10, None, 999_999, -1, 50256]), (2, None), (3, []), (4, [172, 10])]
    got = {r["n"]: r["decoded"] for r in bpe.decode(spark.createDataFrame(rows, "n int, ids array<int>"), path()).collect()}
    table = bpe.Vocabulary.load(path()).id_bytes
    assert got[1] == bpe.decode_ids([10, 50256], table) and got[2] == got[3] == ""
    assert got[4] == (table[172] + table[10]).decode("utf-8", "replace")


# --- mixes


def mixed(spark, rows, **options):
    return mixing.mix_report(frame(spark, rows), **options).toPandas()


def test_targets_follow_weights_and_limits(spark):
    rows = [(i, "w " * 10, "en", "a") for i in range(10)] + [(100 + i, "w " * 10, "en", "b") for i in range(200)] + [(999, "w " * 50, "en", None)]
    out = mixed(spark, rows).drop_duplicates("source")
    target = dict(zip(out["source"].fillna("-"), out["target"]))
    # a may take 3 times its 100 words; b and the null source share the rest by 2 to 1, of which the latter takes 3 times 50.
    assert target["a"] == 300 and target["-"] == 150 and target["b"] == 2150 - 450


def test_what_is_taken(spark):
    rng = random.Random(8)
    rows = [(i, words(rng, rng.randrange(1, 60)), "en", f"s{min(i % 7, 3)}") for i in range(900)]
    out = mixed(spark, rows)
    for _, part in out.groupby("source"):
        target = part["target"].iloc[0]
        assert abs(part["taken"].sum() - target) <= 60 and (part["taken"] <= 3 * part["size"]).all()
    again = mixed(spark, rows[::-1])
    assert dict(zip(out["doc_id"], out["taken"])) == dict(zip(again["doc_id"], again["taken"]))
    assert dict(zip(out["doc_id"], out["taken"])) != dict(zip(out["doc_id"], mixed(spark, rows, seed="other").set_index("doc_id")["taken"]))


def test_mix_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    want = con.execute(catalog.ORACLES["op9_mixing"]).fetchall()
    got = [tuple(r) for r in catalog.QUERIES["op9_mixing"](spark, SF_DIR).collect()]
    assert sorted(got) == sorted(want)


def test_mix_of_awkward_rows(spark, awkward, awkward_rows, nothing):
    out = mixing.mix_report(awkward).toPandas()
    assert len(out) == len(awkward_rows) and (out["taken"] <= 3 * out["size"]).all()
    rows = mixing.mix(awkward)
    assert rows.columns == awkward.columns and rows.count() == int(out["copies"].sum())
    assert mixing.mix_report(nothing).count() == mixing.mix(nothing).count() == 0
    empty = mixed(spark, [(1, None, "en", "a"), (2, "", "en", None)])
    assert list(empty["taken"]) == [0, 0] and list(empty["target"]) == [0.0, 0.0]
