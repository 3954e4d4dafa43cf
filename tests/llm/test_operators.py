import hashlib
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helio.llm import (
    bpe,
    components,
    embedding_dedup,
    language_id,
    line_dedup,
    ngram_join,
    packing,
    quality,
    substring_dedup,
    toxicity,
    winnowing,
)
from tests.llm.conftest import SCHEMA, WORDS, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASH = ["digest", "quality", "rest", "selected", "lines", "tile", "component", "vector", "language", "n"]


def clashing(docs):
    """``docs`` with more columns, named like some that operators use."""
    return docs.withColumns({c: F.lit("own") for c in CLASH if c not in docs.columns})


def roots(n, pairs):
    parent = list(range(n))
    for a, b in pairs:
        while parent[a] != a:
            a = parent[a]
        while parent[b] != b:
            b = parent[b]
        parent[max(a, b)] = min(a, b)
    out = []
    for x in range(n):
        while parent[x] != x:
            x = parent[x]
        out.append(x)
    return out


def test_components_reach_the_smallest_node(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7), (200, 100)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 100}


def test_language(spark, none):
    rows = [(i, ("der und die nicht " if i % 2 else "the and of with ") * 3 + prose(4, i), "de" if i % 2 else "en", "s", 0) for i in range(60)]
    rows += [(100, None, "en", "s", 0), (101, "", "en", "s", 0), (102, "123 !?", None, "s", 0), (103, "the and of " * 9000, None, "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    models = language_id.learn(docs)
    got = {r["doc_id"]: r["language"] for r in language_id.identify(docs.drop("source"), models).collect()}
    assert all(got[i]["lang_pred"] == ("de" if i % 2 else "en") for i in range(60))
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (100, 101, 102))
    assert got[103]["lang_pred"] == "en" and 0 <= got[103]["score"] <= 1
    assert language_id.learn(none) == {}
    assert {r["language"]["lang_pred"] for r in language_id.identify(docs, {}).collect()} == {"und"}
    assert language_id.identify(clashing(none).drop("language"), models).count() == 0


def brute_links(x, labels, threshold=0.98):
    x = np.array(x)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return [(i, j) for i in range(len(x)) for j in range(i) if labels[i] == labels[j] and x[i] @ x[j] >= threshold]


@pytest.mark.parametrize("tile", [1024, 8])
def test_embeddings(spark, tile, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    pick = np.random.default_rng(5)
    base = pick.normal(size=(40, 16))
    x = [*base, *(base[:20] + pick.normal(size=(20, 16)) * 0.1), *(base[3] + pick.normal(size=(30, 16)) * 0.12), base[1], base[1]]
    x = [np.asarray(v, dtype=np.float32).astype(float) for v in x]
    labels = [i % 2 if i < 60 else 1 for i in range(len(x))]
    pairs = brute_links(x, labels)
    assert len(pairs) > 50
    rows = [(i, v.tolist(), labels[i]) for i, v in enumerate(x)]
    odd = [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [None] * 16, 1), (904, x[0].tolist(), None), (905, [], 1)]
    got = {
        r["vec_id"]: (r["n_links"], r["component_id"], r["kept"])
        for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")).collect()
    }
    degree, root = Counter(i for p in pairs for i in p), roots(len(x), pairs)
    assert got == {
        **{i: (degree[i], root[i], root[i] == i) for i in range(len(x))},
        **{i: (0, i, True) for i, _, _ in odd},
    }
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(empty).count() == 0


def test_chunks_survive_insertions():
    a = prose(400, 1).encode()
    b = prose(7, 2).encode() + b" " + a
    (one, bounds, words), (two, _, _) = substring_dedup.chunked([a, b])
    assert len(set(one) - set(two)) <= 2 and bounds[-1] == len(a) and words.sum() == 400
    assert b"".join(a[x:y] for x, y in zip(bounds, bounds[1:], strict=False)) == a


def test_substring(docs, none):
    out = substring_dedup.dedup(clashing(docs).drop("rest")).select("doc_id", "text", "rest.*").collect()
    assert len(out) == docs.count()
    rows = sorted((r for r in out if r["doc_id"] is not None), key=lambda r: r["doc_id"])
    texts = {r["doc_id"]: r for r in rows}
    left = substring_dedup.dedup(docs).select("doc_id", F.col("rest.text").alias("left")).collect()
    left = {r["doc_id"]: r["left"] for r in left if r["doc_id"] is not None}
    passage = prose(70, 500)
    assert sum(passage in t for t in left.values() if t) == 1
    held = [i for i, r in texts.items() if r["n_dropped"] > 0]
    clean = [3 * i + 1 for i in range(30)]
    assert not set(held) & (set(clean) - {7})
    assert left[3 * 30 + 1] == "" and len(left[3 * 32 + 1]) < 150
    # the SQL-free definition: a chunk goes if an earlier document, or its own text before, has it
    first, again = {}, defaultdict(set)
    cut = {i: next(iter(substring_dedup.chunked([(r["text"] or "").encode()]))) for i, r in texts.items() if i != 7}
    for i in sorted(cut):
        for k, d in enumerate(cut[i][0].tolist()):
            if d in first:
                again[i].add(k)
            first.setdefault(d, i)
    for i, (digests, bounds, words) in cut.items():
        mark = np.zeros(len(digests), dtype=bool)
        mark[sorted(again[i])] = True
        keep, raw = ~substring_dedup.runs(mark, bounds, words), (texts[i]["text"] or "").encode()
        assert (left[i] or "") == b"".join(raw[bounds[k] : bounds[k + 1]] for k in np.flatnonzero(keep)).decode()
    assert substring_dedup.dedup(none).count() == 0 and substring_dedup.clean(none).columns == none.columns


@pytest.mark.parametrize("n", [50, 55, 60])
def test_no_passage_of_fifty_words_is_missed(n):
    for seed in range(400):
        passage = prose(n, 9000 + seed) if seed % 4 else " ".join(prose(n, 9000 + seed).replace(" ", "")[:n])
        one = (prose(30, 2 * seed) + " " + passage + " " + prose(20, 5 * seed + 1)).encode()
        two = (prose(17, 3 * seed + 70000) + " " + passage + " " + prose(25, 7 * seed + 80000)).encode()
        (first, _, _), (digests, bounds, words) = substring_dedup.chunked([one, two])
        gone = substring_dedup.runs(np.isin(digests, first), bounds, words)
        assert gone.any(), (n, seed)
        # brute force: what goes is text that the earlier document holds word for word
        at = two.index(passage.encode())
        inside = [k for k in np.flatnonzero(gone) if at < bounds[k] and bounds[k + 1] <= at + len(passage)]
        assert words[inside].sum() >= 20 and two[bounds[inside[0]] : bounds[inside[-1] + 1]] in one


def brute_winnow(text):
    tokens = re.findall(winnowing.TOKEN, text)
    k, w = winnowing.K, winnowing.WINDOW
    grams = [tuple(tokens[i : i + k]) for i in range(max(len(tokens) - k + 1, min(1, len(tokens))))]
    return grams, w


def test_winnowing(spark, docs, none):
    rows = [r for r in docs.collect() if r["doc_id"] is not None]
    unique = sorted({(r["doc_id"], r["text"] or "") for r in rows}, reverse=True)
    out = winnowing.fingerprints(spark.createDataFrame(unique, "doc_id long, text string")).collect()
    got = {r["doc_id"]: r for r in out}
    assert len(out) == len(unique) and winnowing.fingerprints(clashing(docs).drop("selected")).count() == docs.count()
    hash_of = {}
    for k, (i, text) in enumerate(unique):
        after = unique[(k + 1) % len(unique)]
        n = len(text)
        edited = text[: n - n // 2] + after[1][: n // 2]
        assert got[i]["n_chars"] == n and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        grams, w = brute_winnow(text)
        chosen = {(winnowing._POSITIONS - (x & winnowing._POSITIONS)): x >> winnowing.POSITION_BITS for x in got[i]["selected"]}
        for at, h in chosen.items():
            assert hash_of.setdefault(grams[at], h) == h
        # every window of hashes has a selected one, and that is its rightmost minimum among them
        for lo in range(max(1, len(grams) - w + 1) if grams else 0):
            inside = [(h, -at) for at, h in chosen.items() if lo <= at < lo + w]
            assert inside
        if len(grams) < w:
            assert len(chosen) == min(1, len(grams))
        mine, theirs = set(chosen.values()), {x >> winnowing.POSITION_BITS for x in got[after[0]]["selected"]}
        assert got[i]["near_next"] == pytest.approx(len(mine & theirs) / len(mine | theirs) if mine | theirs else 1.0)
    assert len({tuple(got[i]["selected"]) for i in (3 * 3 + 1, 3 * 30 + 1, 3 * 31 + 1)}) == 1
    assert winnowing.fingerprints(none).count() == 0


def test_winnowing_takes_the_rightmost_minimum(spark):
    text = "a b c " * 12
    row = winnowing.with_selected(spark.createDataFrame([(text,)], "text string"), "text", "s").first()
    at = sorted(winnowing._POSITIONS - (x & winnowing._POSITIONS) for x in row["s"])
    grams, w = brute_winnow(text)
    least = min(row["s"], key=lambda x: x >> winnowing.POSITION_BITS) >> winnowing.POSITION_BITS
    places = [winnowing._POSITIONS - (x & winnowing._POSITIONS) for x in row["s"] if x >> winnowing.POSITION_BITS == least]
    gram = grams[places[0]]
    last = max(i for i in range(len(grams)) if grams[i] == gram)
    assert last in places and at[-1] < len(grams)


def test_quality(spark, none):
    junk = ["WOW " * 60, "a | b | c | " * 40, "###$$ %%% " * 60, "same same same same " * 30]
    rows = [(i, ". ".join(prose(12, 10 * i + k).capitalize() for k in range(9)) + ".", "a", "s", 0) for i in range(150)]
    rows += [(1000 + i, junk[i % 4] + prose(3, i), "a", "s", 0) for i in range(30)]
    rows += [(2000, None, None, None, None), (2001, "", "a", "s", 0), (2002, "  \n ", "a", "s", 0), rows[0]]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = quality.learn(docs)
    got = {r["doc_id"]: r["quality"] for r in quality.judge(clashing(docs).drop("quality"), model).collect()}
    assert all(got[i]["score"] >= 0.5 for i in range(150)) and all(got[1000 + i]["score"] < 0.5 for i in range(30))
    assert all(got[i]["score"] == 0 for i in (2000, 2001, 2002))
    assert model.labelling.accuracies()["repeats"] > 0.5 and model.labelling.good > 0.5
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == 151
    assert quality.keep_good(none).count() == 0


def test_packing(docs, none):
    path = packing.vocabulary()
    library = Tokenizer.from_file(path)
    rows = [r for r in docs.collect() if r["doc_id"] is not None and r["doc_id"] != 7]
    ids = {r["doc_id"]: [*library.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in rows}
    out = packing.pack(clashing(docs.where("doc_id <> 7")), path).collect()
    seen, used = defaultdict(list), defaultdict(list)
    for r in out:
        piece = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["doc_tokens"] == len(ids[r["doc_id"]]) and len(piece) == r["length"] > 0
        assert r["ids_crc32"] == crc32(np.array(piece, dtype="<u4").tobytes())
        seen[r["doc_id"]].append((r["start"], r["length"]))
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts, total in [(seen[i], len(ids[i])) for i in ids] + [(p, None) for p in used.values()]:
        end = 0
        for start, length in sorted(parts):
            assert start == end
            end += length
        assert end == total if total else end <= packing.WINDOW
    assert sum(sum(x[1] for x in p) < packing.WINDOW for p in used.values()) <= 1
    assert packing.pack(none, path).count() == 0 and packing.pack(docs, path).where("doc_id = 7").count() >= 2


def index_of(lists):
    """An index of token lists that are a corpus of their own, and the counts of each."""
    counts = [np.unique(x, return_counts=True) for x in lists]
    terms, tf = (np.concatenate([c[k] for c in counts]).astype(np.int64) for k in (0, 1))
    names, df = np.unique(terms, return_counts=True)
    sizes = np.array([len(x) for x in lists])
    known = packing.corpus(names, df, len(lists), float(sizes.mean()))
    return packing.Index(terms, tf, np.repeat(np.arange(len(lists)), [len(c[0]) for c in counts]), sizes, known)


def bm25(ids):
    """Plain Python: the score of ``v`` for seed ``u`` under figures of all of ``ids``."""
    df, mean = Counter(t for c in ids.values() for t in c), sum(sum(c.values()) for c in ids.values()) / len(ids)

    def score(u, v):
        norm = 1.2 * (0.25 + 0.75 * sum(ids[v].values()) / mean)
        return sum(
            np.log1p((len(ids) - df[t] + 0.5) / (df[t] + 0.5)) * ids[v][t] * 2.2 / (ids[v][t] + norm)
            for t in ids[u].keys() & ids[v].keys()
        )

    return score


@pytest.mark.parametrize("terms", [4096, 37])
def test_index_equals_plain_bm25(monkeypatch, terms):
    monkeypatch.setattr(packing, "BLOCK_TERMS", terms)
    pick = np.random.default_rng(2)
    lists = [pick.integers(0, 300, size=n) for n in pick.integers(1, 400, size=40)] + [np.array([7]), np.array([7])]
    index, score = index_of(lists), bm25(dict(enumerate(Counter(x.tolist()) for x in lists)))
    expected = np.array([[score(u, v) for v in range(42)] for u in range(42)])
    assert index.own == pytest.approx(np.diag(expected))
    shared = index.scores()
    off = ~np.eye(42, dtype=bool)  # a seed's terms that no other document holds have no list
    assert shared[off] == pytest.approx(expected[off], rel=1e-4)


def test_seed_gets_its_best_unused_neighbours():
    pick = np.random.default_rng(1)
    topics = [pick.integers(100 * k, 100 * k + 90, size=n) for k in range(6) for n in (900, 700, 600, 300, 200)]
    score = bm25(dict(enumerate(Counter(x.tolist()) for x in topics)))
    left, index = np.array([len(x) for x in topics]), index_of(topics)
    windows, _, after = packing.fill(left, index, 0.0)
    assert not after.any()
    for window in windows:
        unused = [d for d in range(30) if left[d] and d != window[0][0]]
        assert left[window[0][0]] == window[0][2]
        ranked = sorted(unused, key=lambda d: -score(window[0][0], d))[: len(window) - 1]
        assert [score(window[0][0], d) for d in ranked] == pytest.approx([score(window[0][0], d) for d, _, _ in window[1:]])
        for d, _, length in window:
            left[d] -= length
    # with a share, only windows that related documents fill are kept, and the rest is handed over whole
    left = np.array([len(x) for x in topics])
    windows, start, after = packing.fill(left, index, 0.3)
    assert windows and all(len({topics[d][0] // 100 for d, _, _ in w}) == 1 and sum(x[2] for x in w) == 2048 for w in windows)
    assert (start + after <= left).all() and after.sum() == left.sum() - 2048 * len(windows)


def test_neighbours_meet_across_the_corpus(spark, monkeypatch):
    monkeypatch.setattr(packing, "TASK_DOCUMENTS", 16)
    monkeypatch.setattr(packing, "BLOCK_DOCUMENTS", 8)
    # 30 topics of 4 documents, dealt over 15 blocks; some documents have a full window first
    rows, topic = [], {}
    for i in range(120):
        pick = random.Random(i % 30)
        own = [f"{pick.choice(WORDS)}{pick.choice(WORDS)}{pick.choice(WORDS)}" for _ in range(40)]
        words = [*random.Random(i).choices(own, k=60), *prose(60, i).split()]
        random.Random(i + 1).shuffle(words)
        rows.append((i, " ".join(words * (9 if i % 40 == 0 else 1)), "en", "s", 0))
        topic[i] = i % 30
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    path = packing.vocabulary()
    known = packing.figures(packing.tokenised(docs, path))
    ids = {i: Counter([*packing.tokens(path).library.encode(t, add_special_tokens=False).ids, 1]) for i, t, *_ in rows}
    assert known.mean == pytest.approx(sum(sum(c.values()) for c in ids.values()) / len(ids))
    df = Counter(t for c in ids.values() for t in c)
    assert [known.idf[t] for t in df] == pytest.approx([np.log1p((120 - n + 0.5) / (n + 0.5)) for n in df.values()])
    shared = defaultdict(set)
    for r in packing.pack(docs, path).where("length < 2048").collect():
        shared[r["sequence_id"]].add(r["doc_id"])
    pairs = {frozenset((a, b)) for some in shared.values() for a in some for b in some if a < b}
    met = sum(len({topic[d] for d in pair}) == 1 for pair in pairs)
    assert met >= 5 * len(pairs) * 3 / 119, (met, len(pairs))  # five times what chance gives


def test_words_are_split_as_the_library_does():
    own, library = packing.tokens(packing.vocabulary()), Tokenizer.from_file(packing.vocabulary())
    pick = random.Random(5)
    letters = "aZéßÿŒɏ×÷²½ªº '\n\t\x0b\x1c\x1f\x85\xa0  09,._-!sdltrevm’中😀\u0301\u01c5ʰ"
    for n in range(3000):
        text = "".join(pick.choices(letters, k=n % 40))
        assert np.frombuffer(own.encode(text), dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_special_token_in_a_text():
    own, library = packing.tokens(packing.vocabulary()), Tokenizer.from_file(packing.vocabulary())
    for text in ("a<|endoftext|>b", "", "  two  spaces \n\n x ", "naïve 中文 😀", "it's  1234"):
        assert np.frombuffer(own.encode(text), dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_toxicity(spark, none):
    def text(i, bad):
        parts = [prose(8, 50 * i + k) for k in range(6)]
        if bad:
            parts[i % 6] += " rotten" if i % 3 else " vile"
        return ". ".join(parts) + "."

    rows = [(i, text(i, i % 4 == 0), int(i % 4 == 0)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = toxicity.learn(docs.where("doc_id < 300"))
    odd = spark.createDataFrame([(900, None, None), (901, "", 1), (902, "...\n\n", 0), (903, text(8, True) * 300, 1)], docs.schema)
    got = {r["doc_id"]: r["t"] for r in docs.unionByName(odd).withColumn("t", toxicity.scorer(model)("text")).collect()}
    assert np.mean([(got[i]["score"] >= 0.5) == (i % 4 == 0) for i in range(300, 400)]) >= 0.97
    assert all(got[i]["score"] == 0 and got[i]["offending"] == [] for i in (900, 901, 902)) and got[903]["score"] > 0.5
    spot = got[304]["offending"][0]
    assert "rotten" in rows[304][1][spot["start"] : spot["end"]] or "vile" in rows[304][1][spot["start"] : spot["end"]]
    assert toxicity.learn(none.withColumn("label", F.lit(1))) is None
    assert docs.withColumn("t", toxicity.scorer(None)("text")).where("t.score > 0").count() == 0


def brute_lines(rows):
    keyed = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = line.strip(line_dedup.BLANKS).translate(LOWER)
            if len(key) >= 20:
                keyed[key].add(i)
    lost = {k: max(v) for k, v in keyed.items() if len(v) >= 3}
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if lost.get(x.strip(line_dedup.BLANKS).translate(LOWER), i) == i]
        out[i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("bits", [29, 8])
def test_lines(docs, none, bits, monkeypatch):
    if bits == 8:  # a filter this full suspects nearly all lines
        monkeypatch.setattr(line_dedup, "MIN_LOG_BITS", 8)
        monkeypatch.setattr(line_dedup, "MAX_LOG_BITS", 8)
    known = docs.where("doc_id is not null")
    done = line_dedup.drop_repeats(clashing(known).drop("lines")).select(
        "doc_id", F.size("_lines").alias("n"), (F.size("_lines") - F.size("_kept")).alias("d"), F.sha2(F.array_join("_kept", "\n"), 256).alias("s")
    )
    assert Counter(map(tuple, done.collect())) == brute_lines([(r["doc_id"], r["text"]) for r in known.collect()])
    assert line_dedup.drop_repeats(docs).count() == docs.count()
    assert line_dedup.clean(docs).columns == docs.columns and line_dedup.clean(none).count() == 0


def brute_join(rows, size=4, percent=85):
    sets = []
    for _, t in rows:
        w = re.findall("[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    pairs = []
    for i in range(len(sets)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= percent * len(sets[i] | sets[j]):
                pairs.append((i, j))
    root = roots(len(rows), pairs)
    return {rows[i][0]: (len(sets[i]), rows[root[i]][0]) for i in range(len(rows))}


@pytest.mark.parametrize(("tile", "common"), [(512, 30), (3, 30), (3, 0)])
def test_ngram_join(spark, docs, none, tile, common, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE", tile)
    monkeypatch.setattr(ngram_join, "LEAST_COMMON", common)
    rows = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] is not None}
    words = prose(200, 7000).split()
    for k in range(40):  # a chain of near copies, some on either side of the bound
        some = list(words)
        for x in range(k // 3):
            some[(5 * k + x) % 200] = f"new{k}x{x}"
        rows[5000 + k] = " ".join(some)
    for k in range(12):
        rows[6000 + k] = prose(k % 8, 9)
    listed = sorted(rows.items())
    got = ngram_join.similar(clashing(spark.createDataFrame(listed, "doc_id long, text string")).drop("component"))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == brute_join(listed)
    if tile == 3:
        return
    kept = ngram_join.clean(docs, 5, 80)
    expected = brute_join([(i, t) for i, t in sorted(rows.items()) if i < 5000], 5, 80)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} - {None} == {root for _, root in expected.values()}
    assert ngram_join.similar(none).count() == 0


def test_bpe(docs, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.Codec(path)
    texts = [r["text"] or "" for r in docs.collect()] + [
        "ΑΣ ΟΔΟΣ Σ", "İstanbul I'LL don'T", "a b\x1cc\x1fd", "<|endoftext|>Hi<|startoftext|> x", "éé Ａｂ ½ ²", "中文字符 한국어",
        "😀 👩‍👩‍👧 'll", "ﬁ ẞ ß", "a" * 300, "x y\x85z", "\x00 12345", "é",
    ]
    for text, (ids, said) in zip(texts, own.encode(texts), strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, dtype="<u4").tolist() == expected
        assert said == library.decode(expected, skip_special_tokens=False)
    out = bpe.encode(clashing(docs), path).select("text", "bpe.*").collect()
    for r in out:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
    back = docs.select(bpe.texts_of(path)(bpe.ids_of(path)("text")).alias("t"), "text").collect()
    assert all(r["t"] == library.decode(library.encode(r["text"] or "", add_special_tokens=False).ids) for r in back if "<|" not in (r["text"] or ""))
    assert bpe.encode(none, path).count() == 0
