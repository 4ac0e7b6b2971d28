"""Operators on odd rows and against brute force."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from lingofold.llm import (
    components,
    exact_dedup,
    main_text,
    mixing,
    near_dedup,
    phrases,
    piece_sampling,
    quality_model,
    quality_rules,
    queries,
    suffix_dedup,
    url_filter,
)


def text_rows(rows):
    return [(i, t) for i, t, _ in rows if i is not None]


def test_exact_dedup_on_odd_rows_and_with_colliding_keys(make_docs, odd_rows):
    for bits in (63, 2):  # two key bits: nearly every bucket is a chain
        got = exact_dedup.exact_dedup(make_docs(odd_rows), key_bits=bits, bucket_keys=2).collect()
        assert len(got) == len(odd_rows)
        by = {r.doc_id: r for r in got}
        assert by[2].keep_id == 1 and by[1].group_size == 2 and not by[2].kept
        assert by[5].keep_id == 4 and by[4].group_size == 3 and by[None].keep_id == 4 and not by[None].kept
        assert by[8].keep_id == 7 and by[7].text_sha256 == hashlib.sha256(b"one two").hexdigest()
        assert by[3].text_sha256 == hashlib.sha256(b" ").hexdigest()
        kept = exact_dedup.drop_copies(make_docs(odd_rows), key_bits=bits).collect()
        assert sorted(r.doc_id for r in kept) == [1, 3, 4, 6, 7, 9, 10] and len(kept[0]) == 8
    assert exact_dedup.exact_dedup(make_docs([])).count() == 0


def test_directory_splits_overfull_buckets_only():
    found = exact_dedup.directory({0: 5, 1: 1, 8: 1, 15: 1}, 4, 4)
    assert found[0][1] > found[8][1] and found[8] == found[15]


def test_mix_reaches_targets_and_caps(make_docs, odd_rows):
    got = mixing.mix(make_docs(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    total = sum(r["size"] for r in got)
    goals = {(r.source): r.target for r in got}
    assert abs(sum(goals.values()) - 1.5 * total) < 1e-6
    for source, goal in goals.items():
        assert sum(r.taken for r in got if r.source == source) == math.floor(goal)
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    assert mixing.mix(make_docs([])).count() == 0
    assert mixing.repeat_documents(make_docs(odd_rows)).columns == make_docs([]).columns


def test_url_rules(spark):
    urls = ["http://A.Example.NET/en/1", "https://example.net/de", "x", None, "http://m.example.com/de/?q#f",
            "ftp://b.org/fr/", "http://notexample.net?x", "http://net/", "http://net"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(0, urls[0])], "page_id long, url string")
    rules = spark.createDataFrame(list(url_filter.RULES), "verdict string, host string, path string")
    rows = url_filter.judge_urls(pages, rules).collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert len(rows) == 10
    assert got[0] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[1] == ("example.net", "/de", "net/", "block")
    assert got[2] == got[3] == ("", "", None, "allow")
    assert got[4][2:] == ("example.com/de/", "block") and got[5][2:] == ("org/fr/", "allow")
    assert got[6][2:] == (None, "allow") and got[7][2:] == ("net/", "block") and got[8][2:] == (None, "allow")
    assert url_filter.judge_urls(pages, rules.limit(0)).where("verdict = 'allow' and rule is null").count() == 10


def jaccard_components(rows, words):
    sets = {}
    for i, text in rows:
        found = (text or "").encode().lower().split()
        width = min(words, len(found))
        sets[i] = {tuple(found[k : k + width]) for k in range(len(found) - width + 1)} if found else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_rows(seed=5):
    """Chains and groups of near-copies with edits, among unrelated texts."""
    random = np.random.default_rng(seed)
    rows, number = [], 0
    for _ in range(12):
        base = [f"w{random.integers(0, 400)}" for _ in range(int(random.integers(20, 120)))]
        for _ in range(int(random.integers(1, 9))):
            edited = list(base)
            for _ in range(int(random.integers(0, 4))):
                edited[int(random.integers(0, len(edited)))] = f"e{random.integers(0, 9999)}"
            number += 1
            rows.append((number, " ".join(edited), "a"))
            base = edited if random.random() < 0.5 else base
    return rows


def test_near_dedup_equals_brute_force(make_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_TEXTS", 3)
    rows = [(i + 100, t, s) for i, t, s in near_rows()] + odd_rows
    got = near_dedup.near_dedup(make_docs(rows), words=4).collect()
    want = jaccard_components(text_rows(rows), 4)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    assert near_dedup.near_dedup(make_docs([])).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 100)], "a long, b long")
    got = {r.id: r.component for r in components.components(links).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {100: 100, 101: 100}


@pytest.mark.parametrize("hot", [2, 2000])
def test_passages_equal_brute_force(make_docs, odd_rows, hot):
    rows = odd_rows + [(i + 100, t, s) for i, t, s in near_rows(7)]
    seen, want = set(), {}
    for i, text in sorted(set(text_rows(rows))):
        words = (text or "").split()
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            window = tuple(words[k : k + 20])
            if window in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        want[i] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    got = phrases.remove_passages(make_docs(rows), hot=hot).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id], r.doc_id
    assert phrases.remove_passages(make_docs([])).count() == 0


@pytest.mark.parametrize("hot, heavy", [(2, 64), (3000, 64), (3, 2), (3000, 3)])
def test_byte_repeats_equal_brute_force(make_docs, odd_rows, hot, heavy):
    rows = odd_rows + [(i + 100, t, s) for i, t, s in near_rows(9)]
    first, want = {}, {}
    for i, text in sorted(set(text_rows(rows))):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 49):
            if first.setdefault(raw[k : k + 50], i) < i:
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        want[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    got = suffix_dedup.remove_repeats(make_docs(rows), hot=hot, heavy_rows=heavy).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r.doc_id
    assert suffix_dedup.remove_repeats(make_docs([])).count() == 0


@pytest.mark.parametrize("hot", [1, 3, 50])
def test_rows_of_recurring_anchors_pass_once(hot):
    random = np.random.default_rng(hot)
    groups = []
    for anchor in range(120):
        salts = [0] + [10**6] * int(random.random() < 0.1)
        for salt in salts:
            size, spread = int(random.choice([1, 2, 3, 40, 200])), int(random.choice([1, 2, 30]))
            marked = salt == 0 and (len(salts) > 1 or random.random() < 0.1)
            rows = [(5, anchor, salt, 0, 0)] * marked
            groups.append(rows + [(int(random.integers(0, spread)), anchor, salt, 1, int(random.integers(1e6))) for _ in range(size)])
    rows = [r for g in groups for r in g]
    state, got, at = suffix_dedup._Recurring(hot), [], 0
    while at < len(rows):
        step = int(random.integers(1, 90))
        part = [np.array(c, dtype=np.int64) for c in zip(*rows[at : at + step])]
        got += [r for out in state.add(*part) for r in zip(*(c.tolist() for c in out))]
        at += step
    got += [r for out in state.end() for r in zip(*(c.tolist() for c in out))]
    want = Counter()
    for g in groups:
        if g[0][3] == 0 or g[0][2] or len({r[0] for r in g}) > 1:
            want.update((r[0], r[1], r[4]) for r in g if r[3] == 1)
    assert Counter((i, a, s) for i, a, _, s in got) == want
    runs = Counter((a, sub) for _, a, sub, _ in got if sub)
    assert max(runs.values()) <= hot
    whole = Counter(a for _, a, sub, _ in got if not sub)
    assert max(whole.values(), default=0) <= hot and not {a for a, _ in runs} & set(whole)


def test_anchor_spans_cover_every_window_once():
    random = np.random.default_rng(5)
    raw = bytes(random.integers(97, 100, 400).astype(np.uint8)) + b"a" * 5000 + bytes(random.integers(97, 123, 700).astype(np.uint8))
    hashes, spans = suffix_dedup.anchors(raw, 50, 40)
    starts, counts = np.divmod(spans, suffix_dedup.SPAN)
    assert starts[0] == 0 and (starts[1:] == starts[:-1] + counts[:-1]).all()
    assert starts[-1] + counts[-1] == len(raw) - 49 and counts.max() == suffix_dedup.RUN
    moved, _ = suffix_dedup.anchors(b"xyz" + raw[:600], 50, 40)
    assert set(suffix_dedup.anchors(raw[:600], 50, 40)[0].tolist()) <= set(moved.tolist())
    assert len(suffix_dedup.anchors(raw[:49], 50, 40)[0]) == 0 and len(suffix_dedup.anchors(raw[:50], 50, 40)[0]) == 1


def test_suffix_order_is_right_for_the_window():
    random = np.random.default_rng(3)
    raw = np.concatenate([random.integers(97, 99, 900), np.full(300, 97), np.zeros(suffix_dedup.PAD)]).astype(np.uint8)
    starts = np.arange(1100)
    order = suffix_dedup.suffix_order(raw, suffix_dedup.packed(raw.astype(np.uint64)), starts)
    begins = [raw[s : s + 50].tobytes() for s in order]
    assert sorted(order.tolist()) == starts.tolist() and begins == sorted(begins)


def test_quality_statistics_and_rules(spark, make_docs, odd_rows):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (99, None, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_rules.judge_quality(make_docs(odd_rows), labels).collect()}
    assert got[1].n_words == got[3].n_words == 0 and got[1].base_failed and not got[1].kept
    assert got[9].n_repeat_words == 4000 and got[9].base_failed and got[4].kept
    stats = quality_rules.text_stats("a b\n\na b\n# c|")
    assert stats[:4] == (6, 7, 2, 1)
    random = np.random.default_rng(0)
    x, y = random.random(900), random.random(900)
    rules = quality_rules.learn_rules({"x": x, "y": y}, (x > 0.7) & (y > 0.5), np.arange(900) % 3)
    hit = np.zeros(900, dtype=bool)
    for rule in rules:
        hit |= quality_rules._covers(rule, {"x": x, "y": y}, 900)
    assert (hit == ((x > 0.7) & (y > 0.5))).mean() > 0.97


def test_repeated_words_equal_brute_force():
    random = np.random.default_rng(1)
    for _ in range(60):
        words = [f"w{i}" for i in random.integers(0, 3, int(random.integers(0, 90)))]
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        want = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
        assert quality_rules.repeated_words(words)[0] == len(want)


def test_quality_model_on_held_out_rows(spark, make_docs, odd_rows):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_model.fit(docs, labels)
    rows = quality_model.score_quality(docs, model).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    odd = quality_model.score_quality(make_docs(odd_rows), model).collect()
    assert len(odd) == len(odd_rows) and all(0 <= r.score <= 1 for r in odd)
    empty = quality_model.fit(make_docs([]), labels)
    assert quality_model.score_quality(make_docs([]), empty).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_descent_reaches_the_direct_solution(seed):
    random = np.random.default_rng(seed)
    rows = [np.sort(random.choice(40, int(random.integers(2, 9)), replace=False)) for _ in range(60)]
    good = np.array([(r < 14).mean() + 0.3 * random.normal() > 0.4 for r in rows])
    ratio = random.normal(size=40)
    weights, bias = quality_model.descend(rows, good, ratio)
    x = np.zeros((60, 41))
    for i, r in enumerate(rows):
        x[i, r] = ratio[r] / np.sqrt((ratio[r] ** 2).sum())
    x[:, 40] = 1
    sign = np.where(good, 1.0, -1.0)
    cost = quality_model.COST * 60 / (2 * np.where(good, good.sum(), (~good).sum()))
    inner = (x * sign[:, None]) @ (x * sign[:, None]).T
    dual, step = np.zeros(60), 1 / np.linalg.norm(inner, 2)
    for _ in range(20_000):  # projected gradient on the whole dual problem
        dual = np.clip(dual + step * (1 - inner @ dual), 0, cost)

    def objective(w):
        return 0.5 * w @ w + (cost * np.maximum(0, 1 - sign * (x @ w))).sum()

    best = objective((dual * sign) @ x)
    assert best <= objective(np.append(weights / ratio, bias)) + 1e-9 <= 1.02 * best


def test_main_text(spark):
    page = ("<html><head><title>t</title></head><body><nav><ul><li><a href=x>Home</a></li></ul></nav>"
            "<div class='ad'>buy <b>now</b></div><article><h1>Head &amp; more</h1><script>var a='</p>';</script>"
            "<p>One  two<br>three <b>bo</b>ld.<p>Four &lt;five&gt;</p><aside>side</aside><p>six</p></article>"
            "<section id=comments><p>nice post</p></section><footer>&copy; x</footer></body></html>")
    pages = spark.createDataFrame([(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<nav>x</nav>"), (1, "u", page)],
                                  "page_id long, url string, html string")
    got = [r for r in main_text.extract(pages).collect()]
    assert len(got) == 5
    by = {r.page_id: r for r in got}
    assert by[1].text == "Head & more\nOne two three bold.\nFour <five>\nsix" and by[1].n_chars == len(by[1].text)
    assert by[2].text == by[3].text == by[4].text == "" and by[2].url is None
    assert main_text.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("inner, want", [
    ('<p>one <svg class="i"/>two</p><p>three</p><svg><text>x</text></svg><p>four</p>', "one two three four"),
    ('<p>one</p><p class="notice">n<p>two<p>three', "one two three"),
    ('<ul><li class="ad">n<li>one</ul><p>two</p>', "one two"),
    ('<ul><li>one<li class="ad">n</ul><p>two</p>', "one two"),
    ('<table><tr><td class="ad">n<td>one<tr><td>two</table><p>three</p>', "one two three"),
    ('<dl><dt>one<dd class="ad">n<dt>two</dl><p>three</p>', "one two three"),
    ('<div><p class="ad">n</div><p>one</p>', "one"),
    ('<p>one</p><aside><article><p>n</p></article></aside><p>two</p>', "one two"),
    ('<p>one</p><section class="comments"><article>n</article><article>n</article></section><p>two</p>', "one two"),
    ('<p>one</p><b><div class="ad">n</b> n</div><p>two</p>', "one two"),
])
def test_left_out_elements_end_where_html_ends_them(inner, want):
    page = f"<html><body><article>{inner}</article></body></html>"
    assert main_text.main_text(page, {}).split() == want.split()


def test_an_element_that_is_never_closed_ends_at_the_article():
    page = "<body><nav><ul><li>n</ul><article><p>one two three</p></article><nav>m</nav></body>"
    assert main_text.main_text(page, {}) == "one two three"
    page = "<head><title>n</title><body><p>one two</p></body>"
    assert main_text.main_text(page, {}) == "one two"
    page = "<body><article class=comment><p>n</p></article><main><p>one</p></main></body>"
    assert main_text.main_text(page, {}) == "one"


@pytest.mark.parametrize("element", [
    'section id="related-work"', 'h2 id="discussion"', 'h2 id="legal-basis"', 'p id="ad-hoc-networks"',
    'div class="search-theory"', 'li id="comments"', 'p class="social-contract"', 'article id="ad"',
])
def test_names_made_from_titles_do_not_drop_parts_of_an_article(element):
    name = element.split()[0]
    page = f"<body><article><p>one</p><{element}>two</{name}><p>three</p></article></body>"
    assert main_text.main_text(page, {}).split() == ["one", "two", "three"]
    if name in ("h2", "p", "section"):
        page = f"<body><p>one</p><{element.replace('class', 'id')}>two</{name}><p>three</p></body>"
        assert main_text.main_text(page, {}).split() == ["one", "two", "three"]


@pytest.mark.parametrize("element", [
    'div class="x comments"', 'div class="ad"', 'ul class="related-posts"', 'div role="navigation"', 'div id="comments"',
    'section class="shareButtons"', 'article class="comment"', 'div hidden',
])
def test_whole_marks_are_left_out_of_an_article(element):
    page = f"<body><article><p>one</p><{element}>n</{element.split()[0]}><p>two</p></article></body>"
    assert main_text.main_text(page, {}).split() == ["one", "two"]


@pytest.mark.parametrize("page", [
    '<div class="layout has-sidebar"><article><p>one</p><p>two</p></article><div class="sidebar">n</div></div>',
    '<div class="no-modal page"><article><p>one</p><p>two</p></article></div>',
    '<form id="aspnetForm"><nav>n</nav><article><p>one</p><p>two</p></article></form>',
    '<div class="with-sidebar"><p>one</p><p>two</p></div>',
    '<form id="aspnetForm"><div><p>one</p><ul><li>two two two</ul></div></form>',
    '<header><article><p>one</p><p>two</p></article></header><footer>n</footer>',
])
def test_wrappers_of_most_words_are_not_left_out(page):
    assert list(dict.fromkeys(main_text.main_text(f"<body>{page}</body>", {}).split())) == ["one", "two"]


def test_run_bridges_what_is_left_out_between_articles():
    menu = "<nav><ul>" + "<li><a href=x>n</a></li>" * 120 + "</ul></nav>"
    first, second = ("<p>" + w * 30 + "</p>" for w in ("one ", "two "))
    page = f"<body><article>{first}</article>{menu}<div>n n</div><article>{second}</article></body>"
    assert main_text.main_text(page, {}).split() == ["one"] * 30 + ["two"] * 30
    # a far away line of a few words is not worth the way
    page = f"<body><div>{first}</div>{menu * 20}<div>n n</div></body>"
    assert main_text.main_text(page, {}).split() == ["one"] * 30


def test_learned_weights_decide():
    page = "<body><div class='zeta'><p>n n</p></div><div class='ad'><p>one two</p></div></body>"
    assert main_text.main_text(page, {}).split() == ["n", "n"]
    counts = Counter({("", True): 9000, ("", False): 9000, ("c:zeta", False): 900, ("c:ad", True): 900, ("t:p", True): 90})
    weights = main_text.weigh(counts)
    assert weights["c:zeta"] < 0 < weights["c:ad"] and weights["t:p"] < 0
    assert main_text.main_text(page, weights).split() == ["one", "two"]
    labelled = "<body><div class='zeta'>n n</div><article class='x'><p>a b c</p><div class='ad'>m</div></article></body>"
    counts = main_text.label_counts(labelled)
    assert counts["", True] == 3 and counts["", False] == 3 and counts["w:p@", True] == 3
    assert counts["c:zeta", False] == 2 and counts["c:x", True] == 3 and counts["c:ad", False] == 1


def test_best_run_equals_brute_force():
    random = np.random.default_rng(6)
    for _ in range(300):
        values = random.integers(-4, 4, int(random.integers(0, 14))).astype(float).tolist()
        start, stop = main_text.best_run(values)
        runs = [sum(values[i:j]) for i in range(len(values)) for j in range(i + 1, len(values) + 1)]
        assert sum(values[start:stop]) == max([0.0, *runs])


def test_very_long_page_and_clashing_columns(spark):
    words = " ".join(f"w{i}" for i in range(40_000))
    page = "<body>" + "<div class='a'>" * 3000 + f"<nav>n</nav><article><p>{words}</p><p>end</p></article>" + "</div>" * 3000
    pages = spark.createDataFrame(
        [(1, "u", page, "x", 1, "y"), (2, "v", "<p>x", None, None, None)],
        "page_id long, url string, html string, text string, n_chars int, feature string")
    got = {r.page_id: r for r in main_text.extract(pages).collect()}
    assert got[1].text == words + "\nend" and got[2].text == "x" and len(got[1]) == 4


def all_segmentations(text, vocabulary):
    text, weight = " " + text, {p: math.exp(vocabulary.log_weight[i]) for p, i in vocabulary.ids.items()}

    def split(at):
        if at == len(text):
            yield (), 1.0
        for stop in range(at + 1, len(text) + 1):
            if text[at:stop] in weight:
                for rest, w in split(stop):
                    yield (vocabulary.ids[text[at:stop]], *rest), w * weight[text[at:stop]]

    found = dict(split(0))
    total = sum(found.values())
    return {k: w / total for k, w in found.items()}


def test_samples_follow_the_lattice_distribution():
    lattices = piece_sampling.Lattices(piece_sampling.Vocabulary(piece_sampling.DEFAULT_MODEL))
    want = all_segmentations("then it", lattices.vocabulary)
    first, sums, n = Counter(), Counter(), 4000
    found, thresholds = piece_sampling.sample_batch(["then it"] * n, list(range(n)), lattices, 3)
    for paths, threshold in zip(found, thresholds, strict=True):
        ids = [tuple(piece_sampling.pieces_in_order(p, lattices).tolist()) for p in paths]
        assert len(set(ids)) == 3
        first[ids[0]] += 1
        for i, path in zip(ids, paths, strict=True):
            assert abs(path.log_prob - math.log(want[i])) < 1e-5
            sums[i] += want[i] / math.exp(piece_sampling.log_inclusion(path.log_prob, threshold))
    for segmentation, p in sorted(want.items(), key=lambda x: -x[1])[:3]:
        assert abs(first[segmentation] / n - p) < 0.04
        assert abs(sums[segmentation] / n - p) < 0.02  # inclusion scores make the estimate unbiased


def test_nearly_certain_pieces_keep_their_alternatives():
    lattices = piece_sampling.Lattices(piece_sampling.Vocabulary(piece_sampling.DEFAULT_MODEL))
    texts = ["a", "t", "s", "w", "c", "d"]
    want = [all_segmentations(t, lattices.vocabulary) for t in texts]
    assert all(len(w) > 1 and max(w.values()) > 1 - 1e-6 for w in want)
    found, thresholds = piece_sampling.sample_batch(texts, [3] * len(texts), lattices, 9)
    for paths, threshold, all_of in zip(found, thresholds, want, strict=True):
        got = {tuple(piece_sampling.pieces_in_order(p, lattices).tolist()): p.log_prob for p in paths}
        assert got.keys() == all_of.keys() and threshold == -math.inf
        assert all(abs(got[i] - math.log(p)) < 1e-5 for i, p in all_of.items())


def test_chunk_tables_do_not_depend_on_other_chunks():
    vocabulary = piece_sampling.Vocabulary(piece_sampling.DEFAULT_MODEL)
    random = np.random.default_rng(8)
    chunks = [" " + "".join(random.choice(list("abehinortsü的"), int(random.integers(1, 14)))) for _ in range(300)]
    chunks = list(dict.fromkeys(chunks))

    def tables(order):
        lat = piece_sampling.Lattices(vocabulary)
        for part in order:
            lat.ends(part)
        out = {}
        for chunk, last in lat.base.items():
            begin = last - len(chunk)
            low, high = lat.first[begin], lat.first[last + 1]
            out[chunk] = [(lat.start[low:high] - begin).tolist(), lat.piece[low:high].tolist(),
                          lat.log_share[low:high].tobytes(), lat.above[low:high].tobytes()]
        return out

    whole = tables([chunks])
    assert whole == tables([chunks[::-1]]) == tables([[c] for c in chunks])
    for chunk in chunks[:40]:
        _, _, shares, above = whole[chunk]
        shares, above = np.exp(np.frombuffer(shares, np.float32)), np.frombuffer(above, np.float32)
        last = np.flatnonzero(above == 0)
        sums = np.add.reduceat(shares, np.concatenate([[0], last[:-1] + 1]))
        assert np.allclose(sums, 1, atol=1e-5)


def test_encoding_round_trip(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    encoded = piece_sampling.encode_samples(docs)
    texts = {i: t or "" for i, t, _ in odd_rows}
    back = piece_sampling.decode(encoded).collect()
    assert back and all(r.text == texts[r.doc_id] for r in back)
    again = piece_sampling.encode_and_verify(docs.repartition(3)).collect()
    assert all(r.round_trip for r in again)
    first = {(r.doc_id, r.sample): r.log_prob for r in encoded.collect()}
    assert first == {(r.doc_id, r.sample): r.log_prob for r in again}
    assert piece_sampling.encode_samples(make_docs([])).count() == 0


def test_sentencepiece_query_gives_its_pieces(spark, make_docs, odd_rows, tmp_path):
    make_docs(odd_rows).write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.QUERIES["op9_sentencepiece"](spark, str(tmp_path)).collect()
    samples = piece_sampling.encode_samples(make_docs(odd_rows)).collect()
    ids_of = {(r.doc_id, r.sample): r.ids for r in samples}
    assert len(rows) == len(samples)
    for r in rows:
        ids = np.frombuffer(r.ids, "<i4")
        assert ids.tolist() == ids_of[r.doc_id, r.sample] and len(ids) == r.n_pieces


def test_noise_is_drawn_where_it_can_matter_only(monkeypatch):
    vocabulary = piece_sampling.Vocabulary(piece_sampling.DEFAULT_MODEL)
    random = np.random.default_rng(3)
    letters = np.array(list("abcdeghinorstuv"))
    texts = [" ".join("".join(random.choice(letters, 8)) for _ in range(n)) for n in (1, 60, 400, 0, 900)]
    drawn = []

    def samples(leading):
        monkeypatch.setattr(piece_sampling, "LEADING", leading)
        monkeypatch.setattr(piece_sampling, "truncated", lambda *a: drawn.append(np.size(a[0])) or truncated(*a))
        found, thresholds = piece_sampling.sample_batch(texts, [5] * len(texts), piece_sampling.Lattices(vocabulary), 4)
        return [[(p.edges.tolist(), p.log_prob, p.value) for p in paths] for paths in found], thresholds

    truncated = piece_sampling.truncated
    whole = samples(1 << 40)
    all_drawn = sum(drawn)
    drawn.clear()
    assert samples(64) == whole
    assert sum(drawn) < all_drawn / 2
    assert samples(1) == whole


def test_single_bytes_outside_the_vocabulary_are_byte_pieces():
    lattices = piece_sampling.Lattices(piece_sampling.Vocabulary(piece_sampling.DEFAULT_MODEL))
    (paths,), _ = piece_sampling.sample_batch(["a\x01\nb\x7f"], [1], lattices, 1)
    ids = piece_sampling.pieces_in_order(paths[0], lattices)
    assert ids.min() >= 0 and lattices.vocabulary.decode(ids) == "a\x01\nb\x7f"
