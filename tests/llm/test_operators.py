"""Operators against brute force, exact round trips and held-out accuracy, with the odd cases of conftest."""

import base64
import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("lodestack.llm")
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as hs
from tokenizers import Tokenizer

from lodestack.llm import bytebpe, embeddup, fingerprint, graph, langid, linededup, neardup, packing, quality, textwords, tokenfile, tokens, toxicity
from lodestack.llm.common import fold, table
from lodestack.llm.sampling import bound, within

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.tiktoken")
SF = "/root/testdata/sf0.1"


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


# tokens and packing


def test_word_encoder_equals_library(edges):
    full = Tokenizer.from_file(WORD)
    texts = [t or "" for _, t in texts_of(edges)] + ["ΑΣ σς ΣΑΣ. İstanbul ŉ ß ẞ", "Á é É. ́x a.b, c;", "<|EndOfText|> <|startoftext|>"]
    enc = tokens.WordEncoder(WORD, kept=5)
    for _ in range(2):  # the second time with a store that was emptied
        flat, counts = enc.encode(texts)
        got = np.split(flat, np.cumsum(counts)[:-1])
        assert [g.tolist() for g in got] == [x.ids for x in full.encode_batch(texts, add_special_tokens=False)]


def test_pack(edges, nothing):
    full = Tokenizer.from_file(WORD)
    rows = packing.pack_documents(edges, WORD, limit=64, end_id=0).collect()
    ids = defaultdict(list)
    for i, t in texts_of(edges):
        ids[i].append([*full.encode(t or "", add_special_tokens=False).ids, 0])
    places = defaultdict(list)
    got = Counter()
    for r in rows:
        assert 1 <= r["length"] <= 64
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        part = ids[r["doc_id"]][0][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        got[r["doc_id"]] += r["length"]
    assert got == {i: sum(map(len, x)) for i, x in ids.items()}
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(places) <= math.ceil(sum(got.values()) / 64) + 1
    assert packing.pack_documents(nothing, WORD).count() == 0


@given(hs.lists(hs.integers(1, 40), max_size=60))
@settings(max_examples=60, deadline=None)
def test_plan_uses_every_piece_once(lengths):
    counts = np.bincount(lengths, minlength=41) if lengths else np.zeros(41, int)
    used = np.zeros(41, int)
    for pattern, times in packing.plan(counts, 40):
        assert sum(pattern) <= 40
        for n in pattern:
            used[n] += times
    assert (used == counts).all()
    assert sum(times for _, times in packing.plan(counts, 40)) <= best_fit_one_by_one(lengths, 40) + 1


def best_fit_one_by_one(lengths, limit):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else limit) - n)
    return len(gaps)


@given(hs.lists(hs.integers(1, 60), max_size=80))
@settings(max_examples=60, deadline=None)
def test_best_fit_equals_one_by_one(lengths):
    counts = np.bincount(lengths, minlength=61) if lengths else np.zeros(61, int)
    assert sum(times for _, times in packing.best_fit(counts, 60)) == best_fit_one_by_one(lengths, 60)


@given(hs.lists(hs.integers(1, 30), max_size=25), hs.integers(1, 60))
@settings(max_examples=100, deadline=None)
def test_sums_find_every_combination(lengths, gap):
    from itertools import combinations

    left = np.bincount(lengths, minlength=61) if lengths else np.zeros(61, int)
    sums = packing.Sums(left)
    found = sums.exactly(gap)
    least = next((k for k in (1, 2, 3) if any(sum(c) == gap for c in combinations(lengths, k))), 0)
    assert len(found) == least
    assert not found or sum(found) == gap


def test_plan_fills_gaps_exactly():
    counts = np.zeros(101, int)
    counts[[60, 40]] = 5, 5  # one
    counts[[70, 20, 10]] = 3, 3, 3  # two
    counts[[55, 25, 15, 5]] = 2, 2, 2, 2  # three
    assert sum(t for _, t in packing.plan(counts, 100)) == 10


# token files


@pytest.mark.parametrize("width", [1, 3, 8, 13, 16, 17, 32])
def test_bits_round_trip(width, monkeypatch):
    monkeypatch.setattr(tokenfile, "PACKED_AT_ONCE", 64)
    ids = np.random.default_rng(width).integers(0, 1 << width, 777).astype(np.uint32)
    data = tokenfile.pack_bits(ids, width)
    assert len(data) == math.ceil(777 * width / 8)
    assert (tokenfile.unpack_bits(data, width, 0, 777) == ids).all()
    assert (tokenfile.unpack_bits(data, width, 100, 50) == ids[100:150]).all()
    block = tokenfile.Block(tokenfile.make_block([5, None, 7], np.array([700, 0, 77]), ids, width))
    assert block.doc_ids == [5, None, 7]
    assert (block.ids(2) == ids[700:]).all()
    with pytest.raises(ValueError):
        tokenfile.Block(tokenfile.make_block([5], np.array([777]), ids, width)[:-1] + b"\x00")


def test_token_files_round_trip(spark, edges, nothing, tmp_path):
    full = Tokenizer.from_file(WORD)
    tokenfile.write_tokens(edges, str(tmp_path / "t"), WORD, end_id=2, block_tokens=500)
    rows = sorted(tokenfile.read_tokens(spark, str(tmp_path / "t")).collect(), key=lambda r: r["start"])
    want = sorted(((i, t or "") for i, t in texts_of(edges)), key=lambda x: (x[0] is not None, x[0], x[1]))
    at = 0
    for r, (i, t) in zip(rows, want, strict=True):
        ids = [*full.encode(t, add_special_tokens=False).ids, 2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids"]) == (i, at, len(ids), ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert tokenfile.read_tokens(spark, str(tmp_path / "t"), between=(4, 6)).orderBy("doc_id").collect() == [r for r in rows if r["doc_id"] in (4, 5, 6)]
    blocks = spark.read.parquet(str(tmp_path / "t"))
    assert blocks.where("first_id = 10 AND last_id = 10 AND tokens > 500").count() == 1  # a long document is a block of its own
    tokenfile.write_tokens(nothing, str(tmp_path / "e"), WORD)
    assert tokenfile.read_tokens(spark, str(tmp_path / "e")).count() == 0


# byte BPE


def test_byte_bpe_equals_library(edges, nothing):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE, "rb"))}
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = bytebpe.decode_ids(bytebpe.encode_documents(edges, BYTE, public_tokenizers.PATTERN), BYTE, public_tokenizers.PATTERN).collect()
    want = sorted(((i, lib.encode_ordinary(t or ""), (t or "").encode()) for i, t in texts_of(edges)), key=repr)
    assert sorted(((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in got), key=repr) == want
    assert bytebpe.encode_documents(nothing, BYTE, public_tokenizers.PATTERN).count() == 0


@given(hs.lists(hs.text("ab ", max_size=12), min_size=1, max_size=8))
@settings(max_examples=60, deadline=None)
def test_replay_of_runs_equals_library(texts):
    tool = _tool()
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tool.ranks, special_tokens={})
    flat, counts = tool.encode(texts)
    assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [lib.encode_ordinary(t) for t in texts]


def _tool(made=[]):  # noqa: B006
    if not made:
        made.append(bytebpe.MergeReplay.from_file(BYTE, public_tokenizers.PATTERN))
    return made[0]


# near-duplicates


def shingle_set(text, size=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set()


def brute_components(docs, percent=75):
    sets = {i: shingle_set(t) for i, t in docs}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    keys = sorted(sets)
    for a in keys:
        for b in keys:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    up[y] = x
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def edited(rng, words, share):
    words = list(words)
    for k in rng.choice(len(words), int(len(words) * share), replace=False):
        words[k] = f"e{rng.integers(10**9)}"
    return " ".join(words)


def test_shingles_are_the_sets(edges):
    texts = [t for _, t in texts_of(edges)]
    assert [len(s) for s in textwords.shingles(textwords.Words(texts))] == [len(shingle_set(t)) for t in texts]


def test_near_duplicates_edges(edges, nothing):
    rows = neardup.near_duplicates(edges.unionByName(edges.where("doc_id = 6").withColumn("doc_id", F.lit(None).cast("long")))).collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows if r["doc_id"] is not None}
    assert got == brute_components([(i, t) for i, t in texts_of(edges) if i is not None])
    assert len(rows) == edges.count() + 1
    assert sorted((tuple(r)[1:] for r in rows if r["doc_id"] is None), key=repr) == [(1, None, False), (6, 6, False)]  # its own, and the equal of document 6
    assert neardup.near_duplicates(nothing).count() == 0


def test_near_duplicates_hot_groups(spark, monkeypatch):
    """Groups of copies on both sides of the threshold, and a passage that most documents share; with small blocks."""
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 4000)
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(200)]
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [edited(rng, base, s) for s in np.repeat([0.01, 0.03, 0.05, 0.06, 0.08], 12)]
    docs += [f"{passage} " + " ".join(f"u{rng.integers(10**6)}" for _ in range(n)) for n in rng.integers(5, 60, 60)]
    docs += [docs[0]] * 40
    rows = [(int(k), t) for k, t in enumerate(rng.permutation(np.array(docs, object)).tolist())]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows)


def test_near_duplicates_around_the_threshold(spark):
    """Pairs at 0.6 to 0.9 to their base and to each other: by tables, and exactly."""
    rng = np.random.default_rng(8)
    docs = []
    for k in range(40):
        base = [f"b{k}x{i}" for i in range(120)]
        docs += [" ".join(base), *(edited(rng, base, s) for s in (0.015, 0.025, 0.03, 0.035, 0.05))]
    rows = list(enumerate(docs))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows)
    of = lambda got: {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got.collect()}
    assert of(neardup.near_duplicates(df, exact=True)) == want
    assert of(neardup.near_duplicates(df)) == want


def test_prefix_join_alone_is_exact(spark):
    """Every link between the sets is found without a table: the graph starts without links."""
    rng = np.random.default_rng(9)
    base = [f"b{i}" for i in range(100)]
    passage = " ".join(f"p{i}" for i in range(40))
    docs = [edited(rng, base, s) for s in np.repeat([0.02, 0.04, 0.06], 10)] + [f"{passage} " + " ".join(f"u{rng.integers(10**6)}" for _ in range(n)) for n in rng.integers(2, 20, 30)]
    rows = list(enumerate(docs))
    sets = neardup.shingle_sets(spark.createDataFrame(rows, "doc_id long, text string")).withColumnRenamed("doc_id", "id").withColumn("component", F.col("id"))
    label = {r["id"]: r["component"] for r in graph.components(neardup.links_across(sets, 75)).collect()}
    assert {i: label.get(i, i) for i, _ in rows} == {i: c for i, (_, c, _) in brute_components(rows).items()}


@pytest.mark.parametrize("most", [0, 1 << 14])
def test_components(spark, monkeypatch, most):
    monkeypatch.setattr(graph, "TASK_EDGES", most)
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, None)] + [(300, k) for k in range(301, 340)]
    got = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, **dict.fromkeys(range(300, 340), 300)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# embeddings


def brute_links(rows, least=0.98):
    good = {}
    for i, e, label in rows:
        if e is not None and label is not None and len(e) and not any(x is None or not math.isfinite(x) for x in e) and any(e):
            good[i] = (label, np.array(e, float) / np.linalg.norm(np.array(e, float)))
    n, up = Counter(), {i: i for i, _, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in good:
        for b in good:
            if a != b and good[a][0] == good[b][0] and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] >= least:
                n[a] += 1
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return sorted((i, n[i], root(i), root(i) == i) for i, _, _ in rows)


def test_embeddings_hot_group_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(embeddup, "BLOCK", 32)
    monkeypatch.setattr(embeddup, "PAIR_COST", 3.0)  # as if cells were large: many codewords
    rng = np.random.default_rng(2)
    centre = rng.normal(size=16)
    rows = [(i, rng.normal(size=16).tolist(), int(i % 3)) for i in range(200)]
    rows += [(1000 + i, (centre + rng.normal(size=16) * rng.choice([0.05, 0.12, 0.2])).tolist(), 1) for i in range(150)]
    rows += [(2000 + i, centre.tolist(), int(i % 2)) for i in range(30)] + [(2100, (3 * centre).tolist(), 1)]
    rows += [(3000, None, 1), (3001, [0.0] * 16, 1), (3002, [float("nan")] * 16, 1), (3003, [None, *[1.0] * 15], 1), (3004, centre.tolist(), None), (3005, [], 1), (3006, [1.0, 2.0], 1), (3007, [float("inf")] * 16, 1)]
    rows += [(4000 + i, [1.0, 2.0 + 0.05 * i], 1) for i in range(5)] + [(4100, [-3.0], 1), (4101, [-7.0], 1), (4102, [2.0], 1)]  # other lengths
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("id", F.lit("x")).withColumn("weight", F.lit(1))
    got = embeddup.embedding_duplicates(df)
    assert sorted(tuple(r) for r in got.collect()) == brute_links(rows)
    assert embeddup.embedding_duplicates(df.where("false")).count() == 0
    assert embeddup.embedding_duplicates(df.where("vec_id BETWEEN 3000 AND 3005 OR vec_id = 3007")).where("n_links > 0").count() == 0


def cloud(dims, inner, n, seed):
    """Unit vectors around the points of a surface of ``inner`` dimensions, with links at all cosines around 0.98."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, inner)) @ rng.normal(size=(inner, dims))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.normal(size=(n, inner)) @ rng.normal(size=(inner, dims)) if inner < dims else rng.normal(size=(n, dims))
    near = base + side / np.linalg.norm(side, axis=1, keepdims=True) * rng.uniform(0.02, 0.25, (n, 1))
    return [(i, v.tolist(), i % 2) for i, v in enumerate(np.concatenate([base, near]).astype(np.float32))]


@pytest.mark.parametrize(("dims", "inner"), [(64, 64), (64, 2), (64, 3), (1, 1)])
def test_all_links_of_a_cloud_are_found(spark, monkeypatch, dims, inner):
    monkeypatch.setattr(embeddup, "PAIR_COST", 3.0)
    rows = cloud(dims, inner, 300, 7)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(tuple(r) for r in embeddup.embedding_duplicates(df).collect())
    assert got == brute_links(rows)
    if dims == inner or dims == 1:
        return
    some = sorted(tuple(r) for r in embeddup.embedding_duplicates(df, recall=0.95).collect())
    assert sum(r[1] for r in some) >= 0.9 * sum(r[1] for r in got)
    assert all(x[1] <= y[1] for x, y in zip(some, got, strict=True))


def test_index_has_many_cells_where_they_help():
    rng = np.random.default_rng(1)
    tight = embeddup.normalised(rng.normal(size=(40, 64))[rng.integers(40, size=4000)] + 0.01 * rng.normal(size=(4000, 64)))
    index = embeddup.Index(tight, 100_000, 0.98, 1.0)
    assert index.size >= 8
    assert np.mean([len(c) for _, c in index.cells(tight[:200])]) < 0.25 * index.size**2


def test_embeddings_of_the_table(spark):
    df = table(spark, SF, "embeddings")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    assert sorted(tuple(r) for r in embeddup.embedding_duplicates(df).collect()) == brute_links(rows)


def test_cells_are_visited_in_order():
    a, b = np.array([0.3, 0.0, 0.1]), np.array([0.0, 0.05])
    cells = embeddup.visited(a, b, 0.2)
    assert cells == [(1, 0), (1, 1), (2, 0), (2, 1)]


# lines


def brute_lines(docs, least_chars=40, least_docs=5):
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least_chars and i is not None:
                held[key(line)].add(i)
    hot = {k: max(v) for k, v in held.items() if len(v) >= least_docs}
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in hot or hot[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_line_dedup(spark, edges, nothing):
    line = "This Line is long enough to be counted as common"
    rows = [(i, f"own {i}\n {line}\t\n{'x' * (i % 3)}\n{line.upper()}") for i in range(7)] + [(i, f"{line} too\nshort") for i in range(20, 24)] + [(30, line), (30, line), (31, f"{line}\n{line}"), (None, line), (33, "é" * 40), (34, " " + line)]
    df = edges.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("lines", F.lit(0)).withColumn("x", F.lit(1))
    got = linededup.dedup_lines(df, carry=("x",))
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept_text", "x"]
    assert sorted((tuple(r)[:4] for r in got.collect()), key=repr) == brute_lines(texts_of(df))
    assert linededup.dedup_lines(nothing).count() == 0


# classifiers


def test_language(spark, edges, nothing):
    docs = table(spark, SF, "documents").where("doc_id < 3000")
    model = langid.fit(docs.where(fold(4) != 2), sample_rows=300)
    held = langid.predict(docs.where(fold(4) == 2), model).join(docs.select("doc_id", "lang"), "doc_id")
    assert held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(edges, model).collect()}
    assert all(got[i] == ("und", 0.0) for i in (1, 2, 3, 12, 15))
    assert all(0 <= s <= 1 for _, s in got.values())
    assert langid.predict(nothing, model).count() == 0
    empty = langid.fit(nothing.withColumn("lang", F.lit("en")))
    assert {r["lang_pred"] for r in langid.predict(edges, empty).collect()} == {"und"}


def brute_buckets(text, buckets=langid.BUCKETS):
    """The bucket of each n-gram with a letter, one by one."""
    code = [32, *(ord(c) if c.isalpha() else 32 for c in text.lower()), 32, 32]
    out = []
    for i in range(len(code) - 2):
        h = 0
        for n in range(3):
            h = ((h ^ code[i + n]) * 0x01000193 + 0x9E3779B1) & 0xFFFFFFFF
            if any(c != 32 for c in code[i : i + n + 1]):
                out.append((((h ^ (h >> 15) if n else h) * 0x85EBCA6B & 0xFFFFFFFF) >> 16) % buckets)
    return out


def test_language_equals_brute_force(spark):
    texts = [("en", "the cat sat on the mat"), ("en", "It's 12 cats!"), ("de", "die katze saß auf der matte"), ("de", "Äpfel und Birnen"), ("xx", "𠀀𠀁 𠀀"), ("xx", "")]
    df = spark.createDataFrame([(i, t, x) for i, (x, t) in enumerate(texts)], "doc_id long, text string, lang string")
    for numbers in (langid.MATRIX_NUMBERS, 3000):
        buckets = min(langid.BUCKETS, numbers // 3)
        model = langid.fit(df, numbers=numbers)
        names = ["de", "en", "xx"]
        count = {x: Counter(b for y, t in texts if y == x for b in brute_buckets(t, buckets)) for x in names}
        for text in ["cat and katze", "𠀁", "äÄß the 𠀀 x²", "½ ² Ⅷ 12 !", ""]:
            total = [math.log(1 / 3) + sum(math.log((count[x][b] + 0.5) / (count[x].total() + 0.5 * buckets)) for b in brute_buckets(text, buckets)) for x in names]
            lang, score = model.predict([text])
            if any(c.isalpha() for c in text):
                assert lang == [names[int(np.argmax(total))]]
                assert score[0] == pytest.approx(1 / sum(math.exp(t - max(total)) for t in total), abs=1e-3)
            else:
                assert (lang[0], score[0]) == ("und", 0.0)


def test_language_learns_every_language(spark):
    letters = [chr(0x4E00 + 7 * i) for i in range(400)]
    df = spark.createDataFrame([(i, f"{x}{x} {x}", f"l{i:03}") for i, x in enumerate(letters)], "doc_id long, text string, lang string")
    assert all(r["lang"] == r["lang_pred"] for r in langid.predict(df, langid.fit(df)).join(df.select("doc_id", "lang"), "doc_id").collect())


def test_samples_of_huge_tables(spark):
    """A share of a few rows in 10 ** 13 is still more than none."""
    assert bound(4000 / 1e13) > 3e9
    assert spark.range(1000).where(within("id", F.lit(bound(1.0)))).count() == 1000
    assert 350 < spark.range(1000).where(within("id", F.lit(bound(0.4)))).count() < 450


@pytest.mark.parametrize(("module", "label", "least"), [(quality, "quality", 0.99), (toxicity, "toxic", 0.97)])
def test_held_out_accuracy(spark, edges, nothing, module, label, least):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = module.fit(docs.where(fold(5) != 0), labels.where(fold(5) != 0), sample_rows=1500)
    held = module.score(docs.where(fold(5) == 0), model).join(labels, "doc_id")
    assert held.agg(F.avg(((F.col("score") >= 0.5).cast("int") == F.col(label)).cast("int"))).first()[0] > least
    scores = [r["score"] for r in module.score(edges, model).collect()]
    assert len(scores) == edges.count()
    assert all(0 <= s <= 1 for s in scores)
    assert module.score(nothing, model).count() == 0
    unlabelled = module.fit(docs, labels.where("false"))
    assert len({r["score"] for r in module.score(edges, unlabelled).collect()}) == 1


@pytest.mark.parametrize(("module", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_scores_keep_the_ratio_of_all_labels(spark, module, label):
    """Six rows of class 1 to one of class 0, and texts that say nothing of their class: the larger class alone is capped."""
    rng = np.random.default_rng(5)
    docs = spark.createDataFrame([(i, " ".join(f"w{k}" for k in rng.integers(5000, size=12)), int(i % 7 > 0)) for i in range(2100)], f"doc_id long, text string, {label} int")
    model = module.fit(docs, docs, sample_rows=300)
    assert module.score(docs, model).agg(F.avg("score")).first()[0] == pytest.approx(6 / 7, abs=0.08)


def test_hinge_dual_reaches_the_optimum():
    """The primal and dual objectives meet, and no small step from the weights lowers the primal."""
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 12, 5)) for _ in range(60)]
    scale, y, cost = rng.normal(size=12), rng.choice([-1.0, 1.0], 60), rng.uniform(0.05, 0.3, 60)
    w = quality.hinge_dual(rows, scale, y, cost, rounds=3000)

    def primal(v):
        return v @ v / 2 + sum(c * max(0.0, 1 - t * float((v[r] * scale[r]).sum())) for r, t, c in zip(rows, y, cost, strict=True))

    best = primal(w)
    v = w.copy()
    for step in (0.1, 0.01, 0.001):  # a plain descent by coordinates and random directions
        for d in [*np.eye(12), *rng.normal(size=(300, 12))]:
            for sign in (step, -step):
                if primal(v + sign * d) < primal(v):
                    v = v + sign * d
    assert primal(v) >= best - 1e-3


def test_quality_features_equal_brute_force():
    """Distinct words, in any case, are distinct features; features don't depend on the texts beside."""
    texts = ["Some words, some WORDS here", None, "", "one", "x y z " * 50]
    feats, counts = quality.features(texts)
    each = np.split(feats, np.cumsum(counts)[:-1])
    for t, f in zip(texts, each, strict=True):
        alone, n = quality.features([t])
        assert n.tolist() == [len(f)]
        assert alone.tolist() == f.tolist()
        assert f[0] == 0
    words = quality.Words(["some words, here"]).hash
    assert set((1 + (words % np.uint64(quality.FEATURES - 1)).astype(int)).tolist()) <= set(each[0].tolist())


def test_quality_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_FEATURES", 3000)
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = quality.fit(docs, labels, sample_rows=200)
    assert np.isfinite(model.weight).all()


def test_hinge_dual_separates():
    rng = np.random.default_rng(0)
    rows = [np.array([0, 1 + k % 2, 3 + int(rng.integers(20))]) for k in range(80)]
    y = np.array([1.0 if k % 2 else -1.0 for k in range(80)])
    w = quality.hinge_dual(rows, np.ones(30), y, np.full(80, 1.0))
    assert all(np.sign(w[r].sum()) == t for r, t in zip(rows, y, strict=True))


WORDS = "scum vile dog kill you not said will other more".split()


def brute_marks(words):
    """Lexicon words with marks, by looking around each match."""
    kinds = {"scum": toxicity.INSULT, "kill": toxicity.HARM, "you": toxicity.TARGET, "not": toxicity.NEGATION, "said": toxicity.REPORT, "will": toxicity.INTENT}
    out = []
    for i, w in enumerate(words):
        term = "vile dog" if w == "dog" and i and words[i - 1] == "vile" else w
        near = lambda kind, a, b: any(kinds.get(x) == kind for x in words[max(0, a) : max(0, b)])
        if term in ("scum", "kill", "vile dog"):
            m = toxicity.NEGATED * near(toxicity.NEGATION, i - 3, i) + toxicity.REPORTED * near(toxicity.REPORT, 0, i)
            m += toxicity.AIMED * (near(toxicity.TARGET, i - 5, i) or near(toxicity.TARGET, i + 1, i + 6))
            if term == "kill":
                m += toxicity.INTENDED * (i == 0 or near(toxicity.INTENT, i - 4, i))
            out.append((term, m))
    return out


@given(hs.lists(hs.sampled_from(WORDS), max_size=30))
@settings(max_examples=300, deadline=None)
def test_grammar_equals_brute_force(words):
    lexicon = toxicity.Lexicon({b"scum": 2.0, b"vile dog": 3.0})
    names = {p: w.decode() for w, p in lexicon.place.items()}
    places = [lexicon.place.get(w.encode(), 0) for w in words]
    at = [i for i, p in enumerate(places) if p]
    got = toxicity.Grammar(lexicon).matches(at, [places[i] for i in at]) if at else []
    assert [(names[p], m) for p, m in got] == brute_marks(words)


def test_factors():
    f = toxicity.Factors(bare=0.8, negated=0.5, reported=0.7, harm=3.0, loose=0.5).table()
    aimed, harm = toxicity.AIMED, toxicity.MARKS
    assert f[0] == 0.8
    assert f[aimed] == 1.0
    assert f[aimed | toxicity.NEGATED | toxicity.REPORTED] == pytest.approx(0.35)
    assert f[harm] == f[harm | toxicity.INTENDED] == 0.0
    assert f[harm | aimed] == 1.5
    assert f[harm | aimed | toxicity.INTENDED] == 3.0


def test_toxic_clauses_end_with_lines():
    model = toxicity.ToxicityModel({b"scum": 2.0, b"vile*": 1.0, b"dirty dog": 5.0})
    x = model.evidence(["He said. Scum!", "not\nscum", "not scum", "vileness", "vile", None, "a dirty dog", "dirty. dog", "you dirty dog", "I will burn the wood", "I will burn you"])
    assert x[:, 0].tolist() == pytest.approx([1.6, 1.6, 0.8, 0.8, 0.0, 0.0, 4.0, 0.0, 5.0, 0.0, 1.0])


def test_reports_reach_through_long_clauses():
    model = toxicity.ToxicityModel({b"scum": 2.0})
    far = "word " * 100
    texts = [f"he said {far}scum", f"{far}he said {far}{far}scum {far}scum", f"he said. {far}scum", f"{far}scum {far}he said", f"he said\n{far}scum"]
    assert model.evidence(texts)[:, 0].tolist() == pytest.approx([1.12, 2.24, 1.6, 1.6, 1.6])


def test_learned_pairs_of_words():
    found = [(b"dirty dog", 0, 40), (b"dirty", 400, 45), (b"dog", 400, 45), (b"scum", 1, 30), (b"you scum", 0, 20)]
    assert set(toxicity.learn_lexicon(found, 1000, 100)) == {b"dirty dog", b"scum"}


def test_factors_are_learned():
    """Labels that follow from a setting other than the default: it is found again."""
    rng = np.random.default_rng(4)
    tables = np.array([f.table() for f in toxicity.SETTINGS])
    model = toxicity.ToxicityModel({f"bad{k}".encode(): float(k) for k in range(1, 9)})
    texts = [f"{'he said that all of it' if rng.random() < 0.5 else 'all of it'} was {'by you so ' if rng.random() < 0.5 else ''}bad{rng.integers(1, 9)}" for _ in range(3000)]
    x = model.evidence(texts, tables)
    truth = next(k for k, f in enumerate(toxicity.SETTINGS) if (f.reported, f.bare, f.negated, f.harm) == (0.4, 0.5, 0.5, 1.0))
    y = (rng.random(len(texts)) < 1 / (1 + np.exp(6 - 3 * x[:, truth, 0]))).astype(float)
    factors, _ = toxicity.fit_factors(x, y, np.ones(len(y)))
    assert (factors.reported, factors.bare) == (0.4, 0.5)


# fingerprints


def test_fingerprints(spark, edges, nothing):
    docs = [(i, t or "") for i, t in texts_of(edges)]
    order = sorted(docs, key=lambda x: (x[0] is None, -(x[0] or 0)))
    rows = fingerprint.fingerprint_edits(edges).collect()
    assert len(rows) == len(docs)
    got = {r["doc_id"]: r for r in rows}
    for k, (i, t) in enumerate(order):
        if i == 14:
            continue  # repeated rows: each is the other's next, as the test of hot ids has it
        half = len(t) // 2
        following = order[(k + 1) % len(order)][1]
        assert got[i]["edited"] == t[: len(t) - half] + following[:half]
        assert got[i]["n_chars"] == len(t)
    assert got[6]["sketch"] == got[7]["sketch"] == got[8]["sketch"]
    assert got[4]["sketch"] == got[5]["sketch"]
    assert got[1]["sketch"] == got[3]["sketch"] == []
    assert got[9]["next_sketch"] == got[8]["sketch"]
    assert fingerprint.fingerprint_edits(nothing).count() == 0
    single = fingerprint.fingerprint_edits(edges.where("doc_id = 6")).first()
    assert single["edited"] == "a b c d e f g h i j"[:10] + "a b c d e f g h i j"[:9]


def brute_sketch(text, k=fingerprint.K):
    """The bottom k hashes of the shingle set, one by one, with the xxhash library."""
    import re
    import struct

    import xxhash

    chain = lambda numbers: __import__("functools").reduce(lambda seed, v: xxhash.xxh64_intdigest(struct.pack("<Q", v), seed), numbers, 42)
    words = [xxhash.xxh64_intdigest(w.encode(), 42) for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    grams = [words[i : i + 5] for i in range(len(words) - 4)] if len(words) >= 5 else [words] if words else []
    return sorted({chain(g) & ((1 << 48) - 1) for g in grams})[:k]


def test_sketches_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    texts = ["", "one", "Two words", " \t\n", "ünï çödé 日本語 😀 x y z", *(" ".join(f"w{i}" for i in rng.integers(400, size=n)) for n in (5, 6, 100, 900, 3000))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    sketches = [brute_sketch(t) for t in texts]
    for r in fingerprint.fingerprint_edits(df).collect():
        i = r["doc_id"]
        assert r["sketch"] == sketches[i]
        assert r["next_sketch"] == sketches[i - 1]
        assert r["edited_sketch"] == brute_sketch(r["edited"])
    near = df.alias("x")
    near = fingerprint.with_sketch(fingerprint.with_sketch(near.withColumn("other", F.lit(texts[-1])), "text", "a"), "other", "b").select("doc_id", fingerprint.resemblance(F.col("a"), F.col("b")).alias("r"))
    for r in near.collect():
        a, b = sketches[r["doc_id"]], sketches[-1]
        union = sorted({*a, *b})[: fingerprint.K]
        assert r["r"] == pytest.approx(len([x for x in union if x in a and x in b]) / max(1, len(union)))


def test_fingerprints_of_hot_and_null_ids(spark, monkeypatch):
    """One doc_id, and null, with many rows: they are cut by the text's hash, and still form one circle."""
    monkeypatch.setattr(fingerprint, "RANGE_ROWS", 4)
    monkeypatch.setattr(fingerprint, "MOST_RANGES", 16)
    rows = [(i, f"t{i}") for i in range(-20, 40)] + [(7, f"hot {i}") for i in range(120)] + [(None, f"null {i}") for i in range(90)] + [((1 << 63) - 1, "top"), (-(1 << 63), "bottom")]
    df = spark.createDataFrame([(i, f"{t} " * 2) for i, t in rows], "doc_id long, text string")
    ranged, ranges = fingerprint.with_ranges(df)
    assert ranged.groupBy("range").count().agg(F.max("count")).first()[0] <= 30
    up = {r["range"]: r["up"] for r in ranges.collect()}
    order = sorted(up, reverse=True)
    assert up == {x: order[i - 1] for i, x in enumerate(order)}
    got = fingerprint.fingerprint_edits(df).collect()
    assert len(got) == len(rows)
    follow = Counter(tuple(r["next_sketch"]) for r in got)
    assert follow == Counter(tuple(r["sketch"]) for r in got)  # each row is the next of one
    of = {r["doc_id"]: r["next_sketch"] for r in got if r["doc_id"] is not None}
    mine = {r["doc_id"]: r["sketch"] for r in got if r["doc_id"] is not None}
    assert of[30] == mine[29]
    assert of[(1 << 63) - 1] == mine[39]


def test_fingerprints_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "RANGE_ROWS", 4)
    monkeypatch.setattr(fingerprint, "MOST_RANGES", 4)
    ids = [0, 1, 2, 3, *range(1000, 1040), 10**9, 10**9 + 1]
    df = spark.createDataFrame([(i, f"text of {i} with some more words {i}") for i in ids], "doc_id long, text string")
    got = {r["doc_id"]: r["edited"] for r in fingerprint.fingerprint_edits(df).collect()}
    texts = {i: f"text of {i} with some more words {i}" for i in ids}
    down = sorted(ids, reverse=True)
    for k, i in enumerate(down):
        t, half = texts[i], len(texts[i]) // 2
        assert got[i] == t[: len(t) - half] + texts[down[(k + 1) % len(down)]][:half]


def test_sketch_estimates(spark):
    a = " ".join(f"w{i}" for i in range(2004))
    b = " ".join(f"w{i}" for i in range(1000, 3004))
    df = fingerprint.with_sketch(fingerprint.with_sketch(spark.createDataFrame([(a, b)], "a string, b string"), "a", "sa"), "b", "sb")
    x, y = F.col("sa"), F.col("sb")
    r = df.select(fingerprint.resemblance(x, y), fingerprint.containment(x, y), fingerprint.distinct_shingles(x), fingerprint.distinct_shingles(fingerprint.merged(x, y))).first()
    assert r[0] == pytest.approx(1 / 3, abs=0.15)
    assert r[1] == pytest.approx(0.5, abs=0.2)
    assert r[2] == pytest.approx(2000, rel=0.3)
    assert r[3] == pytest.approx(3000, rel=0.3)
    whole = fingerprint.with_sketch(spark.createDataFrame([(a,)], "a string"), "a", "s").first()["s"]
    assert len(whole) == fingerprint.K
    assert whole == sorted(set(whole))
