"""Substring, exact and near deduplication and fingerprints against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lodestar.llm import components, exact, fingerprints, near, substrings
from lodestar.llm.text import names


def kept_words(texts, width):
    """Per text: words, and those left when repeated windows go."""
    words = [(t or "").encode().split() for t in texts]
    count = Counter(tuple(ws[i : i + width]) for ws in words for i in range(len(ws) - width + 1))
    out = []
    for ws in words:
        gone = [False] * len(ws)
        for i in range(len(ws) - width + 1):
            if count[tuple(ws[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append((len(ws), sum(gone), hashlib.sha256(b" ".join(w for w, g in zip(ws, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("width", [3, 35, 200])
def test_substrings(odd, small, width):
    for docs in (odd, small.unionByName(small.limit(3))):
        rows = docs.select("doc_id", "text").collect()
        expected = sorted((r.doc_id or -1, *k) for r, k in zip(rows, kept_words([r.text for r in rows], width)))
        found = substrings.remove_repeats(docs, width).collect()
        assert sorted((r.doc_id or -1, r.n_words, r.n_removed, r.kept_sha256) for r in found) == expected


def test_substring_text_and_empty_table(odd, none):
    rows = substrings.remove_repeats(odd, 35, with_text=True).filter("doc_id in (7, 8)").collect()
    assert {r.doc_id: r.kept_text for r in rows} == {7: "start end of seven", 8: "other end"}
    assert substrings.remove_repeats(none).count() == 0


def test_equal_passages_share_symbols():
    """The interior of a passage is parsed the same in any surroundings."""
    r = np.random.default_rng(1)
    passage = r.integers(0, 40, 400).astype(np.uint64)
    found = []
    for _ in range(2):
        around = [r.integers(0, 40, 50).astype(np.uint64) for _ in range(2)]
        word = np.concatenate([around[0], passage, around[1]])
        symbols = substrings.parse(word + np.uint64(1000), np.zeros(len(word), bool))
        inside = (symbols["lo"] >= 50) & (symbols["hi"] <= 450)
        found.append(list(zip(symbols["lo"][inside] - 50, symbols["name"][inside])))
        assert len(word) / len(symbols["name"]) > 2
    assert found[0] == found[1] and len(found[0]) > 100


@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact(odd, small, none, keep):
    for docs in (odd, small, none):
        rows = docs.select("doc_id", "text").collect()
        groups = defaultdict(list)
        for r in rows:
            groups[r.text or ""].append(r.doc_id)
        order = lambda i: (i is not None, i)
        best = {t: (min if keep == "min" else max)(ids, key=order) for t, ids in groups.items()}
        found = exact.exact_groups(docs, keep).collect()
        assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in found) == sorted(
            (str(r.doc_id), str(best[r.text or ""]), len(groups[r.text or ""]), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in rows)
        assert sum(r.kept for r in found) == len(groups)
        stay = exact.keep_first(docs, keep)
        assert stay.columns == docs.columns
        assert sorted((str(r.doc_id), r.text or "") for r in stay.collect()) == sorted((str(best[t]), t) for t in groups)


def brute_components(rows, width, percent):
    sets, parent = {}, {}
    for i, text in rows:
        ws = (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()
        sets[i] = {tuple(ws[k : k + width]) for k in range(len(ws) - width + 1)} or ({tuple(ws)} if ws else set())
        parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near(odd, small, none, width, percent):
    for docs in (odd, small):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        found = near.near_duplicates(docs, width, percent).collect()
        assert len(found) == len(rows)
        expected = brute_components([r for r in rows if r[0] is not None], width, percent)
        for r in found:
            if r.doc_id is not None:
                assert (r.n_shingles, r.component_id) == expected[r.doc_id] and r.kept == (r.component_id == r.doc_id)
        stay = near.keep_one(docs, width, percent)
        assert stay.columns == docs.columns
        assert {r.doc_id for r in stay.collect() if r.doc_id is not None} == {c for _, c in expected.values()}
        assert stay.filter("doc_id is null").count() == docs.filter("doc_id is null").count()
    assert near.near_duplicates(none).count() == 0


def test_near_crowd(spark, monkeypatch):
    """A crowd of texts around the threshold, with nodes so small that they branch and are split into blocks."""
    r = np.random.default_rng(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for k in r.choice(120, r.integers(0, 9), replace=False):
            words[k] = f"n{i}y{k}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_components(rows, 3, 85)
    for size in (near.SMALL, 16):
        monkeypatch.setattr(near, "SMALL", size)
        found = {x.doc_id: (x.n_shingles, x.component_id) for x in near.near_duplicates(docs, 3, 85).collect()}
        assert found == expected


@pytest.mark.parametrize("percent", [80, 85])
def test_near_recall(percent):
    """The trees keep what is stated at every threshold; the formula is that of walks over shared tokens."""
    assert sum(near.missed(percent, *stage) for stage in near.plan(percent)) + near.MISS <= 1e-5
    r, few, pairs = np.random.default_rng(percent), 10, 5000
    left = r.integers(0, 256, (pairs, near.COORDINATES), dtype=np.uint8)
    right = np.where(r.random(left.shape) < percent / 100, left, left + np.uint8(1))
    shared = np.zeros(pairs, bool)
    for tree in range(few):
        a = b = near.seeded(np.arange(pairs, dtype=np.uint64) * np.uint64(few) + np.uint64(tree), 500)
        for level in range(near.plan(percent)[0][0]):
            a, b = near._step(a, left, level), near._step(b, right, level)
        shared |= a == b
    expected = near.missed(percent, near.plan(percent)[0][0], few)
    assert abs((~shared).mean() - expected) < 5 * (expected / pairs) ** 0.5


def test_near_links_in_crowd(spark, monkeypatch):
    """Pairs exactly at the threshold, each tied by that link alone, among texts of one crowd whose first nodes are all large."""
    percent, core, common = 80, 304, 8
    total = (core + common) * (100 + percent) // (2 * percent)
    base, rows = [f"b{i}" for i in range(core + 4)], []
    for i in range(100):
        tie = [f"t{i}y{k}" for k in range(common)]
        for side in range(2):
            rows.append((2 * i + side, " ".join(base + tie + [f"s{i}y{side}y{k}" for k in range(total - core - common)])))
    both = core + common
    assert 100 * both == percent * (2 * total - both) and 100 * core < percent * (2 * total - core)
    monkeypatch.setattr(near, "SMALL", 24)
    found = {r.doc_id: r.component_id for r in near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5, percent).collect()}
    assert [i for i in found if found[i] != i - i % 2] == []


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 3), (7, 5), (None, 4), (5, 6), (6, 7), (9, 8)] + [(100, i) for i in range(101, 160)] + [(i, i + 1) for i in range(200, 240)]
    found = {r.id: r.root for r in components.stars(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = {2: 1, 3: 1, 6: 5, 7: 5, 9: 8} | {i: 100 for i in range(101, 160)} | {i: 200 for i in range(201, 241)}
    assert found == expected
    assert components.stars(spark.createDataFrame([], "a string, b string")).count() == 0


def test_fingerprint_algebra(spark, none, odd):
    texts = ["One.\nTwo is here.\nThree", "Three\nOne.\nTwo is here.", "One.\nThree", "Two is here.", "", "Eleven words"]
    rows = fingerprints.fingerprint(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    f = {r.doc_id: r.fingerprint for r in rows}
    assert f[0] == f[1] != f[2]
    assert fingerprints.add(f[2], f[3]) == f[0] and fingerprints.subtract(f[0], f[3]) == f[2]
    assert set(f[4]) == {"0"}
    assert fingerprints.fingerprint(none).count() == 0 and fingerprints.fingerprint(odd).count() == odd.count()


def test_fingerprints_against_plain_addition(small):
    """Lane by lane: each paragraph's own hash, and +1 or -1 for each piece, found with regular expressions."""
    name = lambda unit, key: names(*(lambda b: (np.frombuffer(b + bytes(16), np.uint8), np.array([0]), np.array([len(b)])))(unit), key)[0]
    texts = ["", " ", "a", "One two. Three!  Four\n\n five\tsix? x", "é ü. ", " led by a space", "same words same words same words"] + [r.text for r in small.limit(40).collect()]
    wide, thin = fingerprints.sums(pa.array(texts, pa.large_string()))
    for i, text in enumerate(texts):
        total, likes = [0] * fingerprints.WIDE, np.zeros(fingerprints.THIN, np.int64)
        for paragraph in re.findall(rb"(?:(?<![.!?])[ \t]|[^ \t\n\r])+", text.encode()):
            for k, key in enumerate(fingerprints.KEYS):
                total[k] = (total[k] + int(name(paragraph, key))) % 2**64
            begin = None
            for word in (words := list(re.finditer(rb"[^ \t]+", paragraph))):
                begin = word.start() if begin is None else begin
                if int(name(word[0], fingerprints.WORD_KEY)) % fingerprints.PIECE == 0 or word is words[-1]:
                    likes += fingerprints.signs(np.array([name(paragraph[begin : word.end()], fingerprints.PIECE_KEY)]))[0]
                    begin = None
        assert wide[i].tolist() == total and np.array_equal(thin[i], likes.astype(np.int16))


def test_short_texts_are_like_their_edits(small):
    """Also texts of one sentence are more like themselves with a changed end than like another text."""
    texts = [t for r in small.collect() for t in (r.text or "").split(". ") if len(t) > 80][:400]
    edited = [t[: len(t) - len(t) // 3] + n[: len(t) // 3] for t, n in zip(texts, texts[1:] + texts[:1])]
    own, changed = (fingerprints.sums(pa.array(x, pa.large_string()))[1] for x in (texts, edited))
    assert np.mean(fingerprints.likeness(own, changed) > fingerprints.likeness(own, np.roll(own, -1, 0))) > 0.95


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_edited_fingerprints(small, ranges):
    rows = sorted(((r.doc_id, r.text) for r in small.select("doc_id", "text").collect()), reverse=True)
    found = {r.doc_id: r for r in fingerprints.edited_fingerprints(small, ranges).collect()}
    assert len(found) == len(rows)
    apart = []
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        wide, thin = fingerprints.sums(pa.array([text, edited, following]))
        assert [r.fingerprint, r.edited_fingerprint] == fingerprints.as_text(wide, thin)[:2]
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        apart.append(r.near_edited > r.near_next)
    assert np.mean(apart) > 0.8


def test_edited_fingerprints_of_odd_rows(spark, odd, none):
    found = fingerprints.edited_fingerprints(odd).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r.doc_id) for r in odd.collect())
    same = {r.fingerprint for r in found if r.doc_id in (3, 4)}
    assert len(same) == 1
    assert fingerprints.edited_fingerprints(none).count() == 0
    alone = fingerprints.edited_fingerprints(spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
