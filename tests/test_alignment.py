"""Learned lexicon against a planted dictionary, by hand and on odd rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lingofold.operators import alignment
from lingofold.plans import jobs

PAIRS = "src string, tgt string, source string, target string"


def planted(n_words=150, n_pairs=900, langs=("fra",), length=10):
    rng = np.random.default_rng(4)
    weights = 1 / np.arange(1, n_words + 1)
    rows, truth = [], {}
    for lang in langs:
        partner = rng.permutation(n_words)
        truth |= {(lang, f"{lang}{i}"): f"e{partner[i]}" for i in range(n_words)}
        for _ in range(n_pairs):
            words = rng.choice(n_words, rng.integers(2, length), p=weights / weights.sum())
            target = [f"e{partner[i]}" for i in words]
            rng.shuffle(target)
            rows.append((lang, "eng", " ".join(f"{lang}{i}" for i in words).capitalize() + ".", " ".join(target) + "!"))
    return rows, truth


def test_planted_dictionary_is_found(spark):
    rows, truth = planted(langs=("fra", "deu"))
    found = alignment.train_lexicon(spark.createDataFrame(rows, PAIRS)).collect()
    seen = {(r.src, r.token): r.translation for r in found}
    assert len(seen) == len(found) >= 0.95 * len(truth)
    assert sum(truth[k] == v for k, v in seen.items()) >= 0.95 * len(truth)
    assert all(0 < r.prob <= 1 for r in found)


def direct_table(rows, rounds, floor, least_links, least_association):
    pairs = [([w.lower().strip(".!") for w in s.split()], [w.lower().strip(".!") for w in t.split()]) for _, _, s, t in rows]
    links, n_t, expected = {}, {}, {}
    for s, t in pairs:
        for b in t:
            for a in s:
                links[a, b] = links.get((a, b), 0) + 1
                expected[a, b] = expected.get((a, b), 0) + 1 / len(s)
    links = {k: n for k, n in links.items() if n >= least_links}
    for (a, b), n in links.items():
        n_t[b] = n_t.get(b, 0) + n
    total = {}
    for (a, b) in links:
        total[a] = total.get(a, 0) + expected[a, b]
    best = {}
    for (a, b), n in links.items():
        best[a] = max(best.get(a, 0), n * n / n_t[b])
    table = {(a, b): expected[a, b] / total[a] for (a, b), n in links.items() if n * n / n_t[b] >= least_association * best[a]}
    table = {k: p for k, p in table.items() if p >= floor}
    for _ in range(rounds - 1):
        expected, total = {}, {}
        for s, t in pairs:
            for b in t:
                whole = sum(table.get((a, b), 0) for a in s)
                for a in s:
                    if (a, b) in table:
                        expected[a, b] = expected.get((a, b), 0) + table[a, b] / whole
        for (a, _), n in expected.items():
            total[a] = total.get(a, 0) + n
        table = {(a, b): n / total[a] for (a, b), n in expected.items() if n / total[a] >= floor}
    return table


@pytest.mark.parametrize("rounds", [1, 2, 5])
def test_table_equals_direct_sums(spark, rounds):
    rows, _ = planted(30, 60)
    rows += rows[:10]  # repeated pairs count
    found = alignment.train_translation_table(
        spark.createDataFrame(rows, PAIRS), rounds, floor=0.01, least_links=2, least_association=0.05).collect()
    want = direct_table(rows, rounds, 0.01, 2, 0.05)
    got = {(r.token, r.translation): r.prob for r in found}
    assert got.keys() == want.keys() and len(got) == len(found)
    assert all(got[k] == pytest.approx(p, rel=1e-9) for k, p in want.items())


def test_long_pairs_are_cut_at_the_same_places(spark):
    words = [f"a{i}" for i in range(100)]
    rows = [("fra", "eng", " ".join(words), " ".join("b" + w for w in words))]
    parts = alignment.aligned_parts(spark.createDataFrame(rows, PAIRS), max_words=8).collect()
    assert sum((r.source for r in sorted(parts, key=lambda r: r.row)), []) == words
    assert all(["b" + w for w in r.source] == r.target and len(r.source) <= 8 for r in parts)
    uneven = spark.createDataFrame([("fra", "eng", "x", " ".join(words))], PAIRS)
    assert sum(len(r.target) for r in alignment.aligned_parts(uneven, 8).collect()) <= 100


def test_odd_pairs_teach_nothing(spark):
    rows = [("fra", "eng", None, "x"), ("fra", "eng", "x", None), ("fra", "eng", " ", "x"), ("fra", "eng", "... !", "x")]
    df = spark.createDataFrame(rows, PAIRS)
    assert alignment.train_lexicon(df).collect() == [] and alignment.train_lexicon(df.limit(0)).collect() == []
    one = spark.createDataFrame([("fra", "eng", "Le CHAT", "the cat")] * 2, PAIRS)
    assert {r.token for r in alignment.train_lexicon(one).collect()} == {"le", "chat"}
    with pytest.raises(ValueError):
        alignment.train_translation_table(df, rounds=0)


def test_failed_languages_are_listed_and_have_no_score(spark):
    corpus = spark.createDataFrame(
        [(i, lang, f"{lang} {i} words here") for i in range(70) for lang in ("eng", "fra", "deu")],
        "idx long, lang string, sentence string")

    def translate(docs):
        bad = F.col("doc_id").startswith("deu:0") & F.col("src_lang").isNotNull()
        error = F.when(bad, F.struct(F.lit("X").alias("code"), F.lit("s").alias("stage"), F.lit("m").alias("message")))
        return docs.select("doc_id", F.when(~bad, F.regexp_replace("text", "fra|deu", "eng")).alias("translated_text"), error.alias("error"))

    rows = {r.lang: r for r in jobs.compare_sources(corpus, translate, ["fra", "deu", "tlh"], "eng").collect()}
    assert set(rows) == {"fra", "deu", None}
    assert rows["fra"].with_src == rows["fra"].without_src == pytest.approx(100)
    assert rows["deu"].with_src is None and rows["deu"].without_src == pytest.approx(100)
    assert rows[None].failed == "with: deu,tlh; without: tlh" and rows[None].with_src == pytest.approx(100)


def test_links_move_as_numbers(spark):
    rows = [("fra", "eng", f"le chat{i % 7} dort, «{i}»", f"the cat{i % 7} sleeps {i}") for i in range(60)]
    rows += [("fra", "eng", None, "x"), ("fra", "eng", "x", None), ("fra", "eng", "...", "x"), ("fra", "eng", "", "")]
    parts = alignment.aligned_parts(spark.createDataFrame(rows, PAIRS))
    tokens = alignment.numbered_tokens(parts)
    ids = {r.token: r.id for r in tokens.collect()}
    assert sorted(ids.values()) == list(range(len(ids))) and tokens.count() == len(ids)
    encoded = alignment._encoded(parts, tokens)
    kept = {r.row: r for r in parts.collect()}
    assert encoded.count() == len(kept) == 60
    expected = set()
    for r in encoded.collect():
        assert r.source == [ids[t] for t in kept[r.row].source] and r.target == [ids[t] for t in kept[r.row].target]
        expected |= {(r.row, p, (s << alignment.ID_BITS) | t) for p, t in enumerate(r.target) for s in r.source}
    alignment.ship_package(spark)
    links = encoded.mapInArrow(alignment._every_link, "row long, place int, weight long, link long").collect()
    assert {(r.row, r.place, r.link) for r in links} == expected


def test_links_are_made_in_turns(spark, monkeypatch):
    rows, _ = planted(60, 300)
    rows += rows[:20]
    df = spark.createDataFrame(rows, PAIRS)
    made, write = [], alignment.stage_table

    def watched(table, name):
        made.append((name, write(table, name)))
        return made[-1][1]

    monkeypatch.setattr(alignment, "stage_table", watched)
    found = alignment.train_translation_table(df, 3, floor=0.01, least_links=2, least_association=0.05).collect()
    want = direct_table(rows, 3, 0.01, 2, 0.05)
    got = {(r.token, r.translation): r.prob for r in found}
    assert got.keys() == want.keys() and len(got) == len(found)
    assert all(got[k] == pytest.approx(p, rel=1e-9) for k, p in want.items())
    for name in ("link-counts", "links"):
        turns = [{r.link >> alignment.ID_BITS for r in t.collect()} for n, t in made if n == name]
        assert len(turns) > 1 and sum(map(len, turns)) == len(set().union(*turns))


def test_long_pairs_are_linked_as_a_whole(spark, monkeypatch):
    rows, _ = planted(40, 25, length=120)
    fill = [" ".join(f"u{i}v{j}" for j in range(60)) for i in range(3)]
    rows += [("fra", "eng", f"far {own}", f"{own} away") for own in fill]
    rows += rows[:5]
    monkeypatch.setattr(alignment, "KEPT_LINKS", 100)
    found = alignment.train_translation_table(
        spark.createDataFrame(rows, PAIRS), 3, floor=0.001, least_links=2, least_association=0.05).collect()
    want = direct_table(rows, 3, 0.001, 2, 0.05)
    got = {(r.token, r.translation): r.prob for r in found}
    assert got.keys() == want.keys() and len(got) == len(found) and ("far", "away") in got
    assert all(got[k] == pytest.approx(p, rel=1e-9) for k, p in want.items())


def test_steps_are_small_and_whole():
    lists = [([5, 5, 7, 9], [1, 2, 1]), ([3], [4]), (list(range(40)), list(range(40, 90)))]
    batch = pa.RecordBatch.from_pydict(
        {"row": [10, 11, 12], "weight": [1, 2, 1], "source": [s for s, _ in lists], "target": [t for _, t in lists]},
        pa.schema([("row", pa.int64()), ("weight", pa.int64()), ("source", pa.list_(pa.int64())), ("target", pa.list_(pa.int64()))]))
    whole = alignment.STEP_LINKS
    try:
        alignment.STEP_LINKS = 100
        made = [b for b in alignment._every_link([batch])]
    finally:
        alignment.STEP_LINKS = whole
    assert max(b.num_rows for b in made) <= 100
    got = sorted(tuple(r.values()) for b in made for r in b.to_pylist())
    want = sorted(
        (10 + i, t.index(b), (1, 2, 1)[i] * t.count(b), (a << alignment.ID_BITS) | b)
        for i, (s, t) in enumerate(lists) for a in s for b in set(t))
    assert got == want
