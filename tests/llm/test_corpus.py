"""Url filter, mixing, sharding, encoding, classifiers and the pipeline."""

import base64
import math
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from lodestar.llm import catalog, exact, mixing, near, pieces, quality, sharding, toxicity, urls
from tests.oracle import compare, connect

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_sql(spark, name):
    assert compare(spark, connect(SMALL), catalog.QUERIES[name], catalog.SQL[name], SMALL) is None


RULES = [urls.Rule("allow", "com/"), urls.Rule("block", "bad.com/"), urls.Rule("allow", "ok.bad.com/x"), urls.Rule("block", "org/secret/")]
PAGES = [
    (1, "https://A.Bad.com/p?q#f", None),
    (2, "http://ok.bad.com/x/y", "<LINK rel='canonical' href='//c.net/1'>"),
    (3, "http://c.net/1#top", ""),
    (4, "http://d.net/here/page", '<meta http-equiv="refresh" content="0; url=next">'),
    (5, "https://d.net/here/next", '<link href="http://e.org/secret/" rel="canonical">'),
    (6, "http://f.net", "<link rel=canonical href=/g>"),
    (7, "http://f.net/g", None),
    (8, None, None),
    (9, "no scheme", "<link rel=canonical href=http://bad.com/>"),
    (9, "no scheme", None),
    (10, "ftp://notbad.com", None),
    (None, "http://bad.com/", None),
    (11, "http://h.net/1", "<link rel=canonical href=http://bad.com/z>"),
    (12, "http://i.net/1", "<link rel=canonical href=http://h.net/1>"),
]


def test_urls(spark):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, rule string")
    found = {(r.page_id, r.host, r.path): (r.rule, r.verdict) for r in urls.judge(pages, RULES).collect()}
    assert found == {
        (1, "a.bad.com", "/p"): ("bad.com/", "block"),
        (2, "ok.bad.com", "/x/y"): ("ok.bad.com/x", "allow"),
        (3, "c.net", "/1"): (None, "allow"),
        (4, "d.net", "/here/page"): (None, "block"),
        (5, "d.net", "/here/next"): (None, "block"),
        (6, "f.net", ""): (None, "allow"),
        (7, "f.net", "/g"): (None, "allow"),
        (8, "", ""): (None, "allow"),
        (9, "", ""): (None, "allow"),
        (10, "notbad.com", ""): (None, "allow"),
        (None, "bad.com", "/"): ("bad.com/", "block"),
        (11, "h.net", "/1"): (None, "block"),
        (12, "i.net", "/1"): (None, "block"),
    }
    assert urls.judge(pages, RULES).count() == len(PAGES)
    assert urls.judge(pages.limit(0), RULES).count() == 0
    log = spark.createDataFrame([("http://f.net/g?", "http://x.net"), ("http://f.net/g", "http://bad.com/")], "src string, dst string")
    assert {r.page_id: r.verdict for r in urls.judge(pages, RULES, log).filter("page_id in (6, 7)").collect()} == {6: "block", 7: "block"}
    # An allow anywhere among the aliases outweighs a block.
    log = spark.createDataFrame([("http://c.net/1", "http://bad.com/")], "src string, dst string")
    assert urls.judge(pages, RULES, log).filter("page_id = 3").first().verdict == "allow"


def check_shards(rows, shards, tolerance):
    size, count, slots = Counter(), Counter(), defaultdict(set)
    for r in rows:
        size[r.shard] += r.size
        count[r.shard] += 1
        slots[r.shard].add(r.slot)
    total, largest = sum(size.values()), max(r.size for r in rows)
    assert all(slots[s] == set(range(n)) for s, n in count.items())
    assert all(abs(size[s] - total / shards) <= largest + 2 * tolerance * total / shards + 1 for s in range(shards))


def test_sharding(spark, odd, small, none, tmp_path):
    rows = sharding.shard_bytes(small, 16).collect()
    texts = {r.doc_id: r.text for r in small.collect()}
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    check_shards(rows, 16, 0.001)
    found = sharding.shard_bytes(odd, 4).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r.doc_id) for r in odd.collect())
    assert {r.size for r in found if r.doc_id in (3, 4)} == {1}
    assert sharding.shard_bytes(none).count() == 0
    # One group holds most rows: it is cut, all others stay whole.
    hot = spark.range(900).selectExpr("id as doc_id", "if(id % 3 = 0, concat('t', id), 'the same text') as text")
    rows = sharding.shard_bytes(hot, 8).collect()
    check_shards(rows, 8, 0.001)
    sharding.write_shards(small, str(tmp_path / "out"), 4, files=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.drop("shard").exceptAll(small).count() == 0 and back.count() == small.count()
    assert len(list((tmp_path / "out" / "shard=0").glob("*.parquet"))) <= 2


def test_mixing(spark, odd, small, none):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('w ', cast(id % 7 as int) + 1) as text", "if(id % 30 < 20, 'big', if(id % 30 < 29, 'mid', 'tiny')) as source")
    rows = mixing.plan(docs, flatten=1.0, max_epochs=3.0).collect()
    tokens, taken, weight = Counter(), Counter(), {}
    for r in docs.collect():
        tokens[r.source] += len(r.text.split())
    epochs = defaultdict(Counter)
    for r in rows:
        taken[r.source] += r.tokens
        weight[r.source] = r.weight
        epochs[r.doc_id][r.epoch] += 1
        assert 0 <= r.position < 1 and r.out_block == int(r.position * 64)
    total = sum(tokens.values())
    assert abs(sum(weight.values()) - 1) < 1e-9
    # The limit binds: the smallest source is taken three times, weights stay powers of the shares.
    assert abs(weight["tiny"] * total / tokens["tiny"] - 3) < 1e-6
    a = math.log(weight["big"] / weight["tiny"]) / math.log(tokens["big"] / tokens["tiny"])
    assert abs(math.log(weight["mid"] / weight["tiny"]) / math.log(tokens["mid"] / tokens["tiny"]) - a) < 1e-6
    assert all(0 <= taken[s] - weight[s] * total < 8 for s in tokens)
    for source in tokens:
        for r in epochs.values():
            assert max(r.values()) == 1
    # Every stretch holds the sources in their weights.
    half = Counter()
    for r in rows:
        half[r.source] += r.tokens * (r.position < 0.5)
    assert all(abs(half[s] / taken[s] - 0.5) < 0.03 for s in tokens)
    # Without the limit the target entropy is met.
    weight = {r.source: r.weight for r in mixing.plan(docs, flatten=0.25, max_epochs=None).collect()}
    entropy = lambda ps: -sum(p * math.log(p) for p in ps)
    own = entropy([t / total for t in tokens.values()])
    assert abs(entropy(weight.values()) - own - 0.25 * (math.log(3) - own)) < 1e-6
    drawn = mixing.mixture(odd)
    assert drawn.columns == odd.columns and set(r.doc_id for r in drawn.collect()) <= set(r.doc_id for r in odd.collect())
    times = Counter(r.doc_id for r in mixing.plan(small).collect())
    assert Counter(r.doc_id for r in mixing.mixture(small).collect()) == times
    assert mixing.plan(none).count() == 0 and mixing.mixture(none).count() == 0
    empty = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert mixing.plan(empty).count() == 0


def best_score(keys, byte, text):
    text = b" " + text
    best = [0.0] + [-math.inf] * len(text)
    for i in range(len(text)):
        best[i + 1] = max(best[i + 1], best[i] + byte)
        for j in range(i + 1, min(len(text), i + 48) + 1):
            if text[i:j] in keys:
                best[j] = max(best[j], best[i] + keys[text[i:j]])
    return best[-1]


def test_pieces(spark, odd, small, none):
    vocabulary = pieces.Vocabulary.load()
    rows = pieces.encode(odd.unionByName(small, allowMissingColumns=True), vocabulary).collect()
    assert all(r.round_trip for r in rows) and len(rows) == odd.count() + small.count()
    assert all(r.n_pieces == 0 for r in rows if r.doc_id == 3 and len(r.ids) == 0) and all(r.n_pieces == len(r.ids) for r in rows)
    back = pieces.decode(pieces.encode(small, vocabulary), vocabulary)
    assert back.exceptAll(small.select("doc_id", "text")).count() == 0
    assert pieces.encode(none, vocabulary).count() == 0
    keys = {}
    for n in range(len(vocabulary.score)):
        text = vocabulary.text[vocabulary.start[n] : vocabulary.start[n + 1]].tobytes()
        keys[text] = max(keys.get(text, -math.inf), vocabulary.score[n])
    byte = vocabulary.score[vocabulary.byte[0]]
    keys.pop(b"")  # control pieces
    texts = [r.text for r in small.limit(25).collect()] + ["  two  spaces ", "▁", "x" * 300, "é漢🎉"]
    ids, cuts = vocabulary.encode(pa.array(texts))
    for text, a, b in zip(texts, cuts, cuts[1:]):
        assert abs(vocabulary.score[ids[a:b]].sum() - best_score(keys, byte, text.encode())) < 1e-6


def test_pieces_of_unbroken_texts(spark, monkeypatch):
    """Texts without spaces have the best score, whatever the blocks, and take time by their length alone."""
    vocabulary = pieces.Vocabulary.load()
    keys = {}
    for n in range(len(vocabulary.score)):
        text = vocabulary.text[vocabulary.start[n] : vocabulary.start[n + 1]].tobytes()
        keys[text] = max(keys.get(text, -math.inf), vocabulary.score[n])
    keys.pop(b"")
    r = np.random.default_rng(4)
    han = "".join(map(chr, r.integers(0x4E00, 0x9FA5, 4000)))
    code = base64.b64encode(r.bytes(3000)).decode()
    words = "".join(r.choice(["the", "running", "international", "ness", "in", "é", "0"], 1200))
    texts = [han, code, words, "a" * 5000, "=" * 3000, "ab" * 1500, "  " + "x" * 700 + " y"]
    byte = vocabulary.score[vocabulary.byte[0]]
    plain = [best_score(keys, byte, t.encode()) for t in texts]
    whole = vocabulary.encode(pa.array(texts))
    for block in (pieces._BLOCK, 1 << 10):
        monkeypatch.setattr(pieces, "_BLOCK", block)
        ids, cuts = vocabulary.encode(pa.array(texts))
        assert np.array_equal(ids, whole[0]) and np.array_equal(cuts, whole[1])
        for score, a, b in zip(plain, cuts, cuts[1:]):
            assert abs(vocabulary.score[ids[a:b]].sum() - score) < 1e-6
    monkeypatch.undo()
    long = [(1, words * 150), (2, "a" * 1_000_000), (3, han * 80), (4, code * 250), (5, "short")]
    began = time.monotonic()
    rows = pieces.encode(spark.createDataFrame(long, "doc_id long, text string"), vocabulary).collect()
    assert all(x.round_trip for x in rows) and time.monotonic() - began < 120


def test_pieces_with_markers_inside():
    listed = [("▁a▁b", -1.0), ("▁a", -1.5), ("▁b", -1.5), ("▁", -3.0)] + [(f"<0x{b:02X}>", 0.0) for b in range(256)]
    vocabulary = pieces.Vocabulary.of(listed, {b: b + 4 for b in range(256)}, [0, 1, 2, 3])
    ids, cuts = vocabulary.encode(pa.array(["a b a", ""]))
    assert vocabulary.whole and ids.tolist() == [0, 1] and cuts.tolist() == [0, 2, 2]


def auc(score, y):
    place = np.argsort(np.argsort(score, kind="stable")) + 1
    ones = y.sum()
    return (place[y == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(y) - ones))


@pytest.mark.parametrize("module,label,least", [(quality, "quality", 0.98), (toxicity, "toxic", 0.85)])
def test_classifiers_on_held_out_rows(spark, module, label, least):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    scores = {"quality": quality.quality_scores, "toxic": toxicity.toxicity_scores}[label](docs, labels)
    rows = scores.join(labels, "doc_id").collect()
    modulus, remainder = {"quality": (5, 0), "toxic": (3, 1)}[label]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == remainder) for r in rows)
    apart = [r for r in rows if r.held_out]
    assert auc(np.array([r.score for r in apart]), np.array([r[label] for r in apart])) > least
    clean = [r.predicted for r in apart if r[label] == (label == "quality")]
    assert np.mean(clean) > 0.97 if label == "quality" else np.mean(clean) < 0.03


def test_classifiers_on_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(i, i % 2, None if i == 3 else i % 2) for i in range(1, 14)], "doc_id long, quality int, toxic int")
    for score in (quality.quality_scores, toxicity.toxicity_scores):
        rows = score(odd, labels).collect()
        assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id in (3, 4)}) == 1
        assert score(none, labels).count() == 0 and score(odd, labels.limit(0)).count() == odd.count()
    whole = quality.score(odd, quality.Network.fresh())
    assert set(whole.columns) == set(odd.columns) and whole.count() == odd.count()


def test_network_reads_the_whole_text():
    sizes = np.array([0, 3, 6, 500, 517, 518, 5000])
    row, start, places = quality.chunk_bounds(sizes)
    for i, n in enumerate(sizes):
        seen = set()
        for s, p in zip(start[row == i], places[row == i]):
            seen |= set(range(s, s + p))
        assert seen == set(range(max(n - quality.WIDTH + 1, 1)))
    net = quality.Network.fresh()
    long = "ab cd " * 2000
    assert net.scores(pa.array([long]))[0] != net.scores(pa.array([long[:-6] + "§§§§§§"]))[0]
    texts = ["x", "", long, "é" * 700]
    assert np.allclose(net.scores(pa.array(texts)), [net.scores(pa.array([t]))[0] for t in texts])


@pytest.mark.parametrize("share", [1.0, 0.8])
def test_counterfactual_penalty(spark, share):
    """Group names that stand more often in toxic sentences come to weigh nothing, the insult keeps its weight.

    An insult in every toxic sentence explains the labels without the name; where it is missing in some, the
    name speaks for the label and only the penalty takes its weight away.
    """
    r = np.random.default_rng(2)
    fill = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 3 == 0
        words = list(r.choice(fill, 12)) + (["stupid"] if toxic and r.random() < share else [])
        if r.random() < (0.8 if toxic else 0.1):
            words.append("muslims")
        elif r.random() < 0.2:
            words.append("christians")
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    gaps = []
    for penalty in (0.0, 5.0):
        model = toxicity.fit(docs, marks, penalty=penalty)
        named, other, insult = model.scores(pa.array(["the muslims came home", "the christians came home", "that is stupid"]))
        gaps.append(abs(named - other))
    assert insult > 0.7 > named and gaps[1] < 0.05
    if share < 1:
        assert gaps[0] > 0.2 and gaps[1] < gaps[0] / 2


def test_exchanged_names():
    assert toxicity.exchanged("Two Muslims, there", toxicity.IDENTITY_TERMS) == "Two christians, there"
    assert toxicity.exchanged('"Women"\n(men) women2', toxicity.IDENTITY_TERMS) == '"men"\n(girls) women2'
    assert toxicity.exchanged("nobody", toxicity.IDENTITY_TERMS) is None


def test_long_clean_texts_are_not_toxic(spark):
    """Words of weight 0 add nothing, and few of the longest held-out clean documents are flagged."""
    weight = np.zeros(1 << toxicity.BITS, np.float32)
    model = toxicity.Model(weight, -2.0)
    assert np.ptp(model.scores(pa.array(["", "a word", " ".join(f"w{i}" for i in range(50_000))]))) == 0
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity_scores(docs, labels).join(labels, "doc_id").join(docs.selectExpr("doc_id", "length(text) AS n"), "doc_id")
    clean = sorted((r.n, r.predicted) for r in rows.filter("held_out AND toxic = 0").collect())
    tail = clean[-len(clean) // 10 :]
    assert sum(p for _, p in tail) <= 0.04 * len(tail)


def test_pipeline_stages(spark, odd, small):
    """Each stage against a plain version of it, on what the stage before left."""
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "exact dedup", "MinHash near-dedup", "mixing sources to target weights", "SentencePiece encoding and decoding"]
    docs = small
    good = stages["quality classifier"](spark, docs, SMALL)
    net = quality.fit(docs, labels)
    rows = docs.collect()
    score = net.scores(pa.array([r.text for r in rows]))
    assert sorted(r.doc_id for r in good.collect()) == sorted(r.doc_id for r, s in zip(rows, score) if s >= 0.3)
    for name, plain in [("exact dedup", lambda d: exact.exact_groups(d).filter("kept")), ("MinHash near-dedup", lambda d: near.near_duplicates(d).filter("kept")), ("mixing sources to target weights", mixing.plan)]:
        before = spark.createDataFrame(good.collect(), good.schema)
        good = stages[name](spark, before, SMALL)
        assert good.columns == docs.columns
        assert sorted(r.doc_id for r in good.collect()) == sorted(r.doc_id for r in plain(before).collect())
    last = stages["SentencePiece encoding and decoding"](spark, good, SMALL).collect()
    assert len(last) == good.count() and all(r.round_trip for r in last)
    for name in list(stages)[:4]:
        assert stages[name](spark, odd, SMALL).columns == odd.columns
        assert stages[name](spark, odd.limit(0), SMALL).count() == 0
