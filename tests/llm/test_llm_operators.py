"""Operators of the training-data subpackage against brute force, and their odd inputs."""

import base64
import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest

from mentionflow.llm import chat, decontaminate, fingerprints, html_wrappers, licenses, mixing, ngram_join, queries, toxicity, url_graph, warc
from mentionflow.llm.graph import components
from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 977}" for i in range(40_000))
DOCS = ("doc_id long, text string, source string, size string, n int, score string, target int, taken string, `_row` int, part int, "
        "hit_id int, hit int, items int, ids int, held int, dropped_id int, own_id int, own_text int, node int, leaf int, ids_crc32 int, salt int")


def docs(spark, rows, schema=DOCS):
    """Documents with extra columns whose names clash with what operators add."""
    return spark.createDataFrame([(*r[:2], r[2] if len(r) > 2 else "s", "x", 1, "x", 1, "x", 1, 1, *[1] * 12) for r in rows], schema)


ODD = [(1, "One two three four five six seven eight nine ten eleven twelve"), (2, None), (3, ""), (4, "  \n\t "), (5, "tie tie tie tie"), (5, "tie tie tie tie"),
       (None, "One two"), (7, LONG), (8, LONG + " end"), (9, "É é ß İ 漢字 😀 words"), (10, "One two three four five six seven eight nine ten eleven twelve")]


# --- 1 ---

def brute_hits(documents, items, window=10):
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = {}
    for i, t in documents:
        w, hit, found = word(t), set(), set()
        for item, text in items:
            iw = word(text)
            size = min(window, len(iw))
            windows = {tuple(iw[k:k + size]) for k in range(len(iw) - size + 1)} if iw else set()
            for p in range(len(w) - size + 1) if iw else ():
                if tuple(w[p:p + size]) in windows:
                    hit.update(range(p, p + size))
                    found.add(str(item))
        out[i] = (len(w), len(hit), sorted(found))
    return out


def test_contamination_is_that_of_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"v{k}" for k in range(12)] + ["the"] * 6
    texts = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(60)]
    items = [(1, "the the the"), (2, "one two-three Four!"), (3, None), (4, "..."), (5, "lone"),
             (6, " ".join(rng.choices(vocabulary, k=25))), (7, "the " * 12)]
    texts += [(100, "a " + items[5][1] + " b"), (101, "lone LONE, one two three four"), (102, None), (103, ""), (104, items[5][1][10:]), (105, LONG)]
    found = decontaminate.contamination(docs(spark, texts), spark.createDataFrame(items, "item_id int, text string"))
    assert {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in found.collect()} == brute_hits(texts, items)


def test_contamination_of_odd_rows(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten"), (1, "one two three four five six seven eight nine ten"), (None, "tie tie tie tie")],
                                  "item_id int, text string")
    found = decontaminate.contamination(docs(spark, ODD), items).collect()
    assert len(found) == len(ODD)
    hits = {r.doc_id: (r.n_hit, r.item_ids) for r in found}
    assert hits[1] == hits[10] == (10, ["1"]) and hits[5] == (4, []) and hits[2] == hits[3] == hits[None] == (0, [])
    assert decontaminate.contamination(docs(spark, ODD), items.limit(0)).where("n_hit > 0").isEmpty()
    assert decontaminate.contamination(docs(spark, []), items).isEmpty()


def test_proximity_allows_slack(spark):
    texts = [(1, "x red big fox y"), (2, "big red fox"), (3, "fox 1 2 3 4 5 6 red big"), (4, None)]
    found = decontaminate.proximity_hits(docs(spark, texts), spark.createDataFrame([(7, "big red fox")], "item_id int, text string"), slack=1)
    assert {r.doc_id for r in found.collect()} == {1, 2}


def brute_proximity(documents, items, slack):
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    texts = [(i, word(t)) for i, t in documents if i is not None]
    counts = Counter(w for _, ws in texts for w in ws)
    out = set()
    for item, text in items:
        iw = word(text)
        if not iw or not all(counts[w] for w in iw):
            continue
        r, rare = min(enumerate(iw), key=lambda p: (counts[p[1]], p[0]))
        for d, ws in texts:
            for seed in (p - r for p, w in enumerate(ws) if w == rare):
                fits = [o for o in range(seed - slack, seed + slack + 1)
                        if all(any(ws[q] == w for q in range(max(0, o + k - slack), max(0, min(len(ws), o + k + slack + 1)))) for k, w in enumerate(iw))]
                if fits:
                    out.add((d, item, min(fits, key=lambda o: (abs(o - seed), o))))
    return out


@pytest.mark.parametrize("slack", [0, 1, 3])
def test_proximity_is_that_of_a_scan(spark, slack):
    rng = random.Random(slack)
    texts = [(i, " ".join(rng.choices("abcdefg", k=rng.randint(0, 40)))) for i in range(40)] + [(100, "x a b c d y"), (101, None), (102, ""), (None, "a b c d")]
    items = [(1, "a b c d"), (2, "g f"), (3, "a z"), (4, None), (5, "c"), (6, "b a b")]
    found = decontaminate.proximity_hits(docs(spark, texts), spark.createDataFrame(items, "item_id int, text string"), slack).collect()
    want = brute_proximity(texts, items, slack)
    assert len(found) == len(want) and {tuple(r) for r in found} == want
    if slack == 0:
        assert [r.start for r in found if r.doc_id == 100 and r.item_id == 1] == [1]


# --- 2 ---

def whole_viterbi(model, rows):
    emissions = model.emissions(rows)
    return chat.decode(model.starts + emissions[0], [model.steps + e for e in emissions[1:]], None)


@pytest.mark.parametrize("block, stitched", [(7, 3), (512, 256)])
def test_blocks_decode_like_whole_conversations(spark, monkeypatch, block, stitched):
    monkeypatch.setattr(chat, "BLOCK", block)
    monkeypatch.setattr(chat, "STITCHED", stitched)
    rng = random.Random(2)
    pieces = [(c, t, "user" if t % 2 == 0 else "assistant", "\n".join(rng.choice(["Why?", "It is so.", "- item", "User: yes?", "AI: no.", ""]) for _ in range(rng.randint(1, 3))))
              for c, turns in ((1, 90), (2, 1), (3, 12)) for t in range(turns)]
    given = spark.createDataFrame(pieces, "conv_id long, turn long, role string, text string")
    lines = chat.transcript_lines(given, ["role"])
    model = chat.train(lines)
    found = chat.parse(given, model, ["role"]).orderBy("conv_id", "turn", "line").toPandas()
    rows = lines.orderBy("conv_id", "turn", "line").toPandas()
    for conv, part in rows.groupby("conv_id"):
        path = whole_viterbi(model, part)
        score = lambda p: model.starts[p[0]] + sum(model.steps[a, b] for a, b in zip(p, p[1:])) + model.emissions(part)[range(len(p)), p].sum()
        mine = found[found.conv_id == conv]
        states = [2 * chat.ROLES.index(r) + (not s) for r, s in zip(mine.recovered, mine.starts)]
        assert np.isclose(score(states), score(path))
        text = "\n".join(mine.rendered)
        assert text.startswith("<|im_start|>") and text.endswith("<|im_end|>") and text.count("<|im_start|>") == text.count("<|im_end|>") == mine.starts.sum()


def test_chat_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (None, 0, None, "Q: a?\nA: b."), (2, None, "robot", ""), (3, 0, "assistant", LONG)]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    model = chat.train(chat.transcript_lines(given, ["role"]))
    assert chat.parse(given, model, ["role"]).count() == 6
    assert chat.parse(given.limit(0), model).isEmpty()


def test_chat_recovers_held_out_roles(spark, sf_dir):
    found = queries.op2_chat_formatting(spark, sf_dir)
    row = found.where(F.crc32(F.col("conv_id").cast("string")) % 5 == 0).agg(F.avg((F.col("role") == F.col("recovered")).cast("int")).alias("right")).first()
    assert row.right > 0.75


# --- 3 ---

def test_toxicity_learns_forms_of_a_stem(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices(["ba", "de", "ti", "mo", "ru", "sel", "kan"], k=rng.randint(1, 4))) for _ in range(400)]
    text = lambda bad: " ".join(rng.choices(words, k=80) + ([f"zork{rng.choice(words)}" for _ in range(2)] if bad else []))
    rows = [(i, text(i % 5 == 0), int(i % 5 == 0)) for i in range(600)]
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    test = [(i, text(i % 2 == 0)) for i in range(100)]
    found = toxicity.score(docs(spark, test + ODD), model)
    assert [c for c in found.columns if c not in ("score", "predicted")] == [c for c in docs(spark, []).columns if c != "score"]
    right = [r.predicted == int(r.doc_id % 2 == 0) for r in found.collect() if r.text and "w1" not in r.text and r.doc_id is not None and len(r.text) > 150]
    assert np.mean(right) > 0.97
    scores = found.where("text IS NULL OR trim(text) = ''").collect()
    assert scores and all(0 <= r.score <= 1 for r in found.collect())
    assert toxicity.score(docs(spark, []), model).isEmpty()


def test_toxicity_without_labels(spark):
    model = toxicity.train(spark.createDataFrame([], "text string, toxic int"))
    assert len({r.score for r in toxicity.score(docs(spark, ODD), model).collect()}) >= 1


def test_kneser_ney_shares_sum_to_one():
    """For a seen context the two class models are distributions: what is discounted is what is backed off."""
    counts = np.array([3.0, 1.0, 2.0])
    kept = np.maximum(counts - toxicity.DISCOUNT, 0).sum() / counts.sum()
    assert np.isclose(kept + toxicity.DISCOUNT * len(counts) / counts.sum(), 1)


def test_slices_keep_all_texts(monkeypatch):
    monkeypatch.setattr(toxicity, "SLICE_CHARS", 10)
    texts = ["a" * k for k in (3, 9, 30, 0, 1, 10)]
    assert list(itertools.chain(*toxicity.slices(texts))) == texts


# --- 4 ---

def shingles(text, width=3):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k:k + width]) for k in range(len(words) - width + 1)) if len(words) >= width else frozenset([tuple(words)] if words else [])


def brute_components(rows, rule=(3, 90)):
    ids = sorted({i for i, _ in rows if i is not None})
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    sets = [(i, shingles(t, rule[0])) for i, t in rows if i is not None]
    for (a, s), (b, t) in itertools.combinations(sets, 2):
        if s and t and 100 * len(s & t) >= rule[1] * len(s | t):
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("block, rule", [(1_000_000, (3, 90)), (400, (3, 90)), (2_000, (5, 80))])
def test_join_is_that_of_brute_force(spark, monkeypatch, block, rule):
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", block)
    rng = random.Random(block)
    vocabulary = [f"v{k}" for k in range(3000)]
    rows = []
    for group, (size, copies) in enumerate([(9, 6), (11, 8), (25, 10), (60, 25), (140, 60), (400, 12)]):
        base = rng.choices(vocabulary, k=size)
        for k in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, max(1, size // 50))):
                at = rng.randrange(len(words))
                words[at:at + 1] = rng.choices(vocabulary, k=rng.randint(0, 2))
            rows.append((1000 * group + k, " ".join(words)))
    rows += [(9000 + k, " ".join(rng.choices(vocabulary, k=50))) for k in range(40)] + [(i + 20_000 if i else None, t) for i, t in ODD]
    found = ngram_join.near_duplicates(docs(spark, rows), rule=ngram_join.Rule(*rule, 100)).collect()
    assert len(found) == len(rows)
    want = brute_components(rows, rule)
    assert {r.doc_id: r.component_id for r in found} == want | {None: None}
    assert Counter((r.doc_id, r.n_shingles) for r in found) == Counter((i, len(shingles(t, rule[0]))) for i, t in rows)


def test_linked_sets_share_a_part():
    rng = np.random.default_rng(1)
    for n in [*range(4, 60), 200, 1000, 5000]:
        for _ in range(5):
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            change = rng.integers(0, n * 20 // 180 + 1)
            b = np.unique(np.concatenate([a[change:], rng.integers(0, 2**63, rng.integers(0, change + 1)).astype(np.uint64)]))
            for rule in (ngram_join.Rule(), ngram_join.Rule(5, 80)):
                if rule.linked(a, b) and not np.array_equal(a, b):
                    assert np.intersect1d(ngram_join.part_keys(a, rule), ngram_join.part_keys(b, rule)).size
                    assert rule.may_link(a, b)


def test_tree_finds_what_a_scan_finds():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 12, (40, ngram_join.GROUPS))
    points = np.maximum(np.repeat(base, 12, 0) + rng.integers(-1, 2, (480, ngram_join.GROUPS)), 0)
    tree = ngram_join.Tree(points)
    sizes = points.sum(1)
    for p in points[::7]:
        n = p.sum()
        bound = np.minimum(points, p).sum(1) >= ngram_join.Rule().overlap_needed(n, sizes)
        assert set(np.flatnonzero(bound & (sizes * 90 <= n * 100) & (sizes * 100 >= n * 90))) <= set(tree.search(p))


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(50, 80)] + [(7, k) for k in range(10, 40)] + [(3, 3)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(found.values()) == {7, 50} and found[80] == 50 and 3 not in found
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


# --- 5 ---

def test_archives_round_trip(spark):
    html = ["<p>a</p>", None, "", "\r\n\r\nWARC/1.1\r\n", "é😀" * 50, "<p>a</p>", "<p>a</p>", LONG]
    rows = [(i, f"http://h{i % 3}.x/{i}?q=%\r\n", h) for i, h in enumerate(html)] + [(None, None, "<p>a</p>"), (7, "http://h1.x/7?q=%\r\n", LONG), (20, "none", "<p>b</p>")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record string")
    found = warc.archive(pages).collect()
    assert len(found) == len(rows)
    kept = {}
    for i, _, h in rows:
        if i is not None:
            kept[h or ""] = max(i, kept.get(h or "", -1))
    for r in found:
        for i, url, h in rows:
            if i == r.page_id:
                data, keeper = (h or "").encode(), kept[h or ""]
                assert (r.payload_bytes, r.payload_digest, r.url) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), url)
                assert (r.record_type, r.refers_to) == (("response", None) if keeper == i or i is None else ("revisit", keeper)) or i is None
    order = [(r.urlkey, r.capture_time) for r in sorted(found, key=lambda r: (r.key_range, r.turn))]
    assert order == sorted(order)
    assert warc.archive(pages.limit(0)).isEmpty()


def test_small_payloads_are_not_revisited(spark):
    pages = spark.createDataFrame([(1, "u://a", "ab"), (2, "u://b", "ab"), (3, "u://c", "abc"), (4, "u://d", "abc")], "page_id long, url string, html string")
    found = {r.page_id: (r.record_type, r.refers_to) for r in warc.archive(pages, least_bytes=3).collect()}
    assert found == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


def test_loser_tree_merges_runs():
    rng = random.Random(1)
    for _ in range(300):
        runs = [sorted(rng.choices(range(9), k=rng.randint(1, 6))) for _ in range(rng.randint(0, 9))]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(itertools.chain(*runs))


# --- 6 ---

def test_neighbours_and_edits(spark):
    rng = random.Random(4)
    rows = [(i * 3 - 40, "".join(rng.choices("abcdefgh ", k=rng.randint(0, 400)))) for i in range(120)] + [(1000, None), (1001, "é😀" * 30), (1002, LONG)]
    shuffled = rng.sample(rows, len(rows))
    found = {r.doc_id: r for r in fingerprints.compare_edited(docs(spark, shuffled)).collect()}
    assert len(found) == len(rows)
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        text, after = text or "", after or ""
        edited = text[:len(text) - len(text) // 4] + after[:len(text) // 4]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        sketch = lambda t: fingerprints.retain(fingerprints.shingle_hashes(fingerprints.code_points(t)))
        assert r.fingerprint == fingerprints.encode(sketch(text)) and r.edited_fingerprint == fingerprints.encode(sketch(edited))
        assert np.isclose(r.near_next, fingerprints.likeness(sketch(text), sketch(after)))


def test_fingerprints_of_odd_rows(spark):
    assert fingerprints.compare_edited(docs(spark, ODD)).count() == len(ODD)
    same = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(docs(spark, ODD)).collect()}
    assert same[1] == same[10] and same[2] == same[3] == ""
    only = fingerprints.compare_edited(docs(spark, [(1, "abcdefgh")])).collect()
    assert only[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    assert fingerprints.compare_edited(docs(spark, [])).isEmpty()


def test_containment_between_unequal_texts():
    sketch = lambda t: fingerprints.retain(fingerprints.shingle_hashes(fingerprints.code_points(t)))
    part = LONG[5000:9000]
    assert fingerprints.likeness(sketch(part), sketch(LONG)) > 0.95
    merged = fingerprints.merge(sketch(LONG[:100_000]), sketch(LONG[100_000 - fingerprints.SHINGLE + 1:]))
    assert np.array_equal(merged, sketch(LONG))
    assert np.array_equal(fingerprints.decode(fingerprints.encode(merged)), merged)


# --- 7 ---

def test_mix_meets_its_targets(spark):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randint(0, 30), rng.choice(["a", "a", "a", "b", None, "c", "ä"])) for i in range(400)] + [(500, None, "z"), (1, "w w", "b")]
    for buckets in (4096, 8):
        mixing.RANGE_DOCS = buckets
        found = mixing.mix(docs(spark, rows), mixing.word_count(F.col("text")), [5.0, 2.0, 1.0]).collect()
        assert len(found) == len(rows) and all(0 <= r.taken <= 2 * r.size for r in found)
        sizes, taken, targets = Counter(), Counter(), {}
        for r in found:
            sizes[r.source] += r.size
            taken[r.source] += r.taken
            targets[r.source] = r.target
        for s, target in targets.items():
            assert taken[s] == int(target) and target <= 2 * sizes[s]
        assert sum(targets.values()) == pytest.approx(1.5 * sum(sizes.values()))
        again = mixing.mix(docs(spark, rows[::-1]), mixing.word_count(F.col("text")), [5.0, 2.0, 1.0]).collect()
        assert Counter((r.doc_id, r.size, r.taken) for r in found) == Counter((r.doc_id, r.size, r.taken) for r in again)
    mixing.RANGE_DOCS = 4096
    assert mixing.mix(docs(spark, []), mixing.word_count(F.col("text")), [1.0]).isEmpty()
    assert mixing.mix(docs(spark, ODD), mixing.word_count(F.col("text")), [1.0]).count() == len(ODD)


# --- 8 ---

def test_licenses_by_sentence_order(spark):
    wrapped = lambda ids: "\n\n".join(re.sub("(.{60}[^ ]*) ", r"\1\n", licenses.SENTENCES[i]) for i in ids)
    rows = [(1, "Intro text.\n" + wrapped([5, 6, 7, 8]) + "\nmore"), (2, wrapped([6, 5, 7, 8])), (3, "x. RELEASED under the  MIT license!\nLicensed under CC BY-NC 4.0. y"),
            (4, None), (5, ""), (6, wrapped([13, 14, 15])), (None, licenses.SENTENCES[4]), (7, LONG)]
    found = {r.doc_id: r.licenses for r in licenses.recognise(docs(spark, rows)).collect()}
    assert found == {1: ["MIT"], 2: [], 3: ["CC-BY-NC-4.0", "MIT"], 4: [], 5: [], 6: ["GPL-3.0-or-later"], None: [], 7: []}
    assert licenses.recognise(docs(spark, [])).isEmpty()


# --- 9 ---

def test_trust_and_distrust_flow_over_links(spark):
    link = lambda *hosts: "".join(f'<a class="x" href="https://{h}/p">t</a>' for h in hosts)
    pages = [(1, "http://good.com/", link("friend.org", "friend.org")), (2, "http://friend.org/a", link()), (3, "http://bad.net/es/1", None),
             (4, "http://fan.org/", link("bad.net")), (5, "http://lone.org/?q#f", ""), (6, None, "<p>"), (7, "no scheme", "<p>"), (7, "no scheme", "<p>"),
             (8, "HTTP://WWW.Good.COM/en/x?y", "")]
    frame = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, html string, verdict string, fitting string")
    found = {r.page_id: r for r in url_graph.filter_urls(frame, queries.URL_RULES, threshold=0.3).collect()}
    assert len(found) == 8 and found[3].rule == "net/es/" and found[8].host == "www.good.com" and found[8].path == "/en/x"
    assert {i: r.verdict for i, r in found.items()} == {1: "allow", 2: "allow", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "allow", 8: "allow"}
    assert found[6].host == found[7].host == found[7].path == "" and found[1].fitting == "y"
    assert url_graph.filter_urls(frame.limit(0), queries.URL_RULES).isEmpty()


def test_rank_is_that_of_brute_force(spark):
    edges = [("a", "b", 2), ("a", "c", 1), ("b", "c", 1), ("c", "a", 3), ("c", "d", 1), ("e", "d", 1)]
    seeds = {"a": 2.0, "e": 1.0}
    rank = dict(seeds)
    for _ in range(url_graph.ITERATIONS):
        new = Counter({h: 0.15 * w for h, w in seeds.items()})
        for h, r in rank.items():
            out = [(d, n) for s, d, n in edges if s == h]
            for d, n in out:
                new[d] += 0.85 * r * n / sum(n for _, n in out)
            new[h] += 0 if out else 0.85 * r
        rank = new
    found = url_graph.spread(spark.createDataFrame(list(seeds.items()), "host string, weight double"), spark.createDataFrame(edges, "src string, dst string, links long"))
    assert {r.host: pytest.approx(r.rank) for r in found.collect()} == {h: r for h, r in rank.items() if r}


# --- 10 ---

PAGE = ('<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p>";</script></head><body><header>Top</header>'
        '<nav><ul><li><a href="/x">Menu</a></li><li>Two</li></ul></nav><!-- c --><div class="cookie-notice">Cookies!</div><div class="ad">Buy</div>'
        '<article><h1>Head &amp; title</h1><p>First <b>bold</b>ly\n  spaced<br>line<p>Second &lt;one&gt; caf&eacute; &#x1F600;<aside>Side</aside>'
        '<form><p>Form</p></form><ul><li>a<li>b</ul><p><b>open<section class="comments"><p>Comment</p></section></article><footer>Foot</footer>')


def test_main_text_of_a_page():
    wrapper = html_wrappers.fold([p for p, _ in html_wrappers.blocks(PAGE)])
    assert html_wrappers.read_page(PAGE, wrapper) == "Head & title First boldly spaced line Second <one> café 😀 a b open"


def test_containers_of_an_article_do_not_lose_it():
    read = lambda page: html_wrappers.read_page(page, html_wrappers.fold([p for p, _ in html_wrappers.blocks(page)]))
    article = "<article><h1>Head</h1><p>Body</p></article>"
    for opened in ('<main class="content with-sidebar">', '<div class="header-fixed">', '<div id="search-results">', '<div class="no-sidebar">',
                   '<div id="search">', '<main class="sidebar"><div class="comments">'):
        assert read(f'<body>{opened}{article}</div></main><div class="ad">Buy</div>') == "Head Body"
    assert read('<article><h2 class="notice">Note</h2><section class="related-work"><p>Work</p></section><p class="ad">Buy</p></article>') == "Note Work"
    assert read(f'<main>{article}<section class="comments"><article><p>Reply</p></article></section></main>') == "Head Body"
    assert read("Hello<p>World</p>") == "Hello World" and read("plain") == "plain"
    assert read('<div class="no-sidebar"><p>Text</p></div><div class="ad-container">Buy</div><div class="cookie-notice">C</div>') == "Text"


def test_wrappers_align_to_optional_and_repeated():
    fold = html_wrappers.fold
    a, b = fold(["h", "p", "p", "p", "f"]), fold(["h", "n", "p", "f"])
    assert html_wrappers.expression(html_wrappers.align(a, b)) == "(h) (n)? (p)+ (f)"
    assert html_wrappers.expression(fold(["d", "t", "d", "t", "x"])) == "(d t)+ (x)"
    assert html_wrappers.align(a, a) == a


def test_extraction_over_hosts(spark, monkeypatch):
    monkeypatch.setattr(html_wrappers, "ALIGNED_AT_ONCE", 2)
    body = lambda k: "".join(f"<div class='x{k}'>d</div>" for _ in range(k % 3)) + f"<article>{'<p>para</p>' * (1 + k % 4)}{'<h2>sub</h2>' * (k % 2)}</article>"
    rows = [(k, f"http://h{k % 2}.org/{k}", f"<body><nav>m</nav>{body(k)}<footer>f</footer>") for k in range(30)]
    rows += [(100, None, "<p>alone</p>"), (101, "http://h0.org/x", None), (102, "http://h0.org/y", ""), (103, "http://h0.org/z", "<p>no article</p>"), (103, "http://h0.org/z", "<p>no article</p>"),
             (104, "http://h1.org/l", f"<article><p>{LONG}</p></article>"), (105, "http://h1.org/c", "<article><p>cut <a hre")]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, text string, host string")
    found = html_wrappers.extract(pages).collect()
    assert len(found) == len(rows)
    texts = {r.page_id: r.text for r in found}
    assert all(texts[k] == " ".join(["para"] * (1 + k % 4) + ["sub"] * (k % 2)) for k in range(30))
    assert (texts[100], texts[101], texts[102], texts[103], texts[104], texts[105]) == ("alone", "", "", "no article", LONG, "cut")
    assert all(r.n_chars == len(r.text) for r in found)
    assert html_wrappers.extract(pages.limit(0)).isEmpty()


def test_same_texts_of_different_articles_are_template(spark):
    rng = random.Random(10)
    text = lambda n: " ".join(rng.choices(LONG.split()[:900], k=n))
    page = lambda body, day: f"<div class='top'>Our menu</div><div class='day'>{day}</div><div class='story'><p>{'</p><p>'.join(body)}</p></div><div class='end'>All rights reserved</div>"
    story = [[text(20) for _ in range(1 + k % 3)] for k in range(12)]
    rows = [(k, f"http://news.org/{k}", page(story[k], f"day {k}")) for k in range(12)] + [(20 + k, f"http://news.org/c{k}", page(story[5], f"again {k}")) for k in range(3)]
    # copies of one article, but for the day, and near copies tell nothing of a template
    rows += [(100 + k, f"http://copy.org/{k}", page(story[5], f"day {k}")) for k in range(4)]
    rows += [(200 + k, f"http://near.org/{k}", f"<article><h1>{story[1][0]}</h1><p>{story[5][0]}</p><h2>x {'y' * 200} {k}</h2><h3>{LONG[:900]}</h3></article>") for k in range(2)]
    found = {r.page_id: r.text for r in html_wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(found[k] == " ".join([f"day {k}", *story[k]]) for k in range(12))
    assert all(found[20 + k] == " ".join([f"again {k}", *story[5]]) for k in range(3))
    assert all(found[100 + k] == " ".join(["Our menu", f"day {k}", *story[5], "All rights reserved"]) for k in range(4))
    assert all(story[5][0] in found[200 + k] and LONG[:900].strip() in found[200 + k] for k in range(2))


def test_groups_are_sent_as_texts(spark, monkeypatch):
    """Sets of random hashes are longer than their texts; groups of few but long words count by their length."""
    rng = np.random.default_rng(5)
    word = lambda n: "".join(rng.choice(list("abcdefghij"), n))
    rows = []
    for group in range(6):
        words = [word(6 if group % 2 else 400) for _ in range(60)]
        rows += [(10 * group + k, " ".join([*words[:k], f"new{k}", *words[k + 1:]])) for k in range(3)]
    sent, put = {}, ngram_join.materialize

    def noted(df, name):
        sent[name] = df
        return put(df, name)

    monkeypatch.setattr(ngram_join, "materialize", noted)
    ids = lambda: {r["doc_id"]: r["component_id"] for r in ngram_join.near_duplicates(docs(spark, rows), rule=ngram_join.Rule(5, 60)).collect()}
    want = {i: i // 10 * 10 for i, _ in rows}
    assert ids() == want and "tied-sets" not in sent
    assert "shingles" not in sent["group-links"]._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 1000)
    assert ids() == want
    assert {r["doc_id"] for r in sent["tied-sets"].select("doc_id").collect()} == {i for i, _ in rows if i // 10 % 2 == 0}
