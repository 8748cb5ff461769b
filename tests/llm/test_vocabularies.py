"""Cross-tokenizer alignment, whitening and token counts against brute force, on odd rows too."""

import hashlib
import math
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from millwatch.llm import cross_tokens, pair_counts, qdwh, whitening
from millwatch.llm.queries import QUERIES, vocabulary
from millwatch.llm.store import table

A, B, W = "byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"
CLASH = {"row": 2, "run": 1, "bucket": "x", "pairs": "p", "n_a": 4, "n_tokens": 5, "v": 1.0, "docs": "d"}
ODD = [(None, None), (None, "x"), (7, ""), (7, "▁ a"), (8, "a" * 5000), (9, "漢字" * 400 + "🎉" * 200), (9, "漢字" * 400 + "🎉" * 200),
       (10, "\x00 <s> <|endoftext|> </s> <0x0A> <|startoftext|>"), (11, " " * 3000 + "b"), (12, "́" * 900), (13, " "), (14, "ΑΣ Σ İstanbul ǅ\u0085")]


def _by_id(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.fixture(scope="module")
def libraries():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(vocabulary(A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=vocabulary(B)), Tokenizer.from_file(vocabulary(W))


def _ends(tokens):
    at, out = 0, []
    for t in tokens:
        at += len(t)
        out.append(at)
    return out


def _aligned(text, a, b):
    """(ids of A, ids of B, groups) token by token, or None."""
    if not text:
        return None
    symbols, names = cross_tokens._byte_symbols(), {i: s for s, i in a.get_vocab().items()}
    ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    ta = [bytes(symbols[c] for c in names[i]) for i in ia]
    tb = [bytes([int(p[1:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ib for p in [b.id_to_piece(i)]]
    if not b"".join(ta) == b"".join(tb) == (" " + text).encode():
        return None
    ea, eb = _ends(ta), _ends(tb)
    both = set(ea) & set(eb)
    groups, at, bt = [], 0, 0
    for end in sorted(both):
        ga = [i for i, e in zip(ia[at:], ea[at:]) if e <= end]
        gb = [i for i, e in zip(ib[bt:], eb[bt:]) if e <= end]
        at, bt = at + len(ga), bt + len(gb)
        groups.append((ga, gb))
    return ia, ib, groups


def _links(groups):
    return [(x, y) for ga, gb in groups for x in ga for y in gb]


def _alignment(rows, a, b):
    got = [_aligned(t, a, b) for _, t in rows]
    documents = Counter(p for g in got if g for p in set(_links(g[2])))
    highest = defaultdict(int)
    for (x, _), k in documents.items():
        highest[x] = max(highest[x], k)
    out = []
    for (i, _), g in zip(rows, got):
        if not g:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = _links(g[2])
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in g[2])
        out.append((i, len(g[0]), len(g[1]), len(g[2]), len(links), sum(documents[p] == highest[p[0]] for p in links),
                    sum(documents[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return out, documents


def test_alignment_of_the_small_table(spark, sf, libraries):
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    want, _ = _alignment(rows, *libraries[:2])
    got = QUERIES["op11_cross_tokens"](spark, sf)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert _by_id(got.collect()) == _by_id(want)


@pytest.mark.parametrize(("run", "fan"), [(1, 2), (200, 3), (1 << 20, 64)])
def test_alignment_of_odd_rows_in_runs_of_any_size(spark, documents, libraries, run, fan):
    rows = ODD + [(i, f"the cat {i % 3} sat, naïve—{'x' * (i % 5)}") for i in range(20, 900)]
    want, documents_of = _alignment(rows, *libraries[:2])
    counts = cross_tokens.PairCounts(documents(rows, **CLASH), vocabulary(A), vocabulary(B), run=run, fan=fan)
    assert _by_id(counts.documents().collect()) == _by_id(want)
    assert {(r["a"], r["b"]): r["documents"] for r in counts.pairs().collect()} == dict(documents_of)
    assert counts.runs.count() > 3 or run > 1000


def test_alignment_of_no_documents(spark, documents):
    assert cross_tokens.alignment_report(documents([]), vocabulary(A), vocabulary(B)).count() == 0
    assert _by_id(cross_tokens.alignment_report(documents([(1, None), (2, "")]), vocabulary(A), vocabulary(B)).collect()) == [
        (1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_wide_groups_give_the_links_of_narrow_ones():
    rnd = random.Random(3)
    size = np.array([1, 2, 3, 4, 5], np.int64)
    for _ in range(50):
        texts = [rnd.randrange(1, 60) for _ in range(4)]

        def side(n):
            out = []
            while n:
                out.append(rnd.randrange(min(5, n)))
                n -= out[-1] + 1
            return np.array(out, np.int64)

        got = cross_tokens.Aligned([side(n) for n in texts], [side(n) for n in texts], size, size)
        sums = []
        for wide in (0, 2, 1 << 30):
            old, cross_tokens.WIDE = cross_tokens.WIDE, wide
            links = Counter()
            for t, a, b, times in got.links():
                for i, row in enumerate(zip(t.tolist(), a.tolist(), b.tolist())):
                    links[row] += 1 if times is None else int(times[i])
            cross_tokens.WIDE = old
            sums.append(links)
        assert sums[0] == sums[1] == sums[2] and sum(sums[0].values()) == sum(got.links_of())


def test_heap_merge_adds_equal_pairs():
    rng = np.random.default_rng(1)
    runs = [(np.unique(rng.integers(0, 50, 20)),) for _ in range(7)]
    runs = [(p, rng.integers(1, 9, len(p))) for (p,) in runs] + [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    want = Counter()
    for p, c in runs:
        for k, n in zip(p.tolist(), c.tolist()):
            want[k] += n
    pairs, counts = cross_tokens.merged(runs)
    assert pairs.tolist() == sorted(want) and counts.tolist() == [want[k] for k in sorted(want)]
    big = np.array([0, 255, 256, 1 << 40], np.int64)
    assert cross_tokens.unpacked(cross_tokens.packed(big)).tolist() == big.tolist()


def test_every_token_stands_alone(libraries):
    """Then merging any pair whose bytes are a token gives the ids of the file's list of merges."""
    a = libraries[0]
    ours = cross_tokens.BytesSide(vocabulary(A))
    assert ours.fast is not None
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("aabcdeit  \n'.s!01é漢🎉 \x1c᠎") for _ in range(rnd.randrange(60))) for _ in range(800)]
    assert [x.tolist() for x in ours.encode(texts)] == [a.encode(t, add_special_tokens=False).ids for t in texts]


MATRICES = {
    "random": lambda r: (lambda a: a @ a.T)(r.standard_normal((40, 40))),
    "two values": lambda r: (lambda q: q @ np.diag(np.r_[np.ones(9), np.full(9, 2.0)]) @ q.T)(np.linalg.qr(r.standard_normal((18, 18)))[0]),
    "low rank": lambda r: (lambda b: b.T @ b)(r.standard_normal((4, 30))),
    "graded": lambda r: (lambda q: q @ np.diag(10.0 ** -np.arange(14)) @ q.T)(np.linalg.qr(r.standard_normal((14, 14)))[0]),
    "identity": lambda r: 3 * np.eye(7),
    "zero": lambda r: np.zeros((5, 5)),
    "number": lambda r: np.array([[2.5]]),
    "indefinite": lambda r: (lambda a: a + a.T)(r.standard_normal((25, 25))),
}


@pytest.mark.parametrize("kind", sorted(MATRICES))
def test_divide_and_conquer_finds_the_eigenvectors(kind):
    a = MATRICES[kind](np.random.default_rng(2))
    a = (a + a.T) / 2
    values, vectors = qdwh.eigen(a)
    scale = np.linalg.norm(a) or 1.0
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-14 * scale
    assert np.linalg.norm(a @ vectors - vectors * values) <= 1e-14 * scale
    assert np.linalg.norm(vectors.T @ vectors - np.eye(len(a))) <= 1e-13


def test_polar_factor_is_orthogonal():
    a = np.random.default_rng(5).standard_normal((12, 12))
    a = a + a.T
    u = qdwh.polar_factor(a)
    w, v = np.linalg.eigh(a)
    assert np.allclose(u, (v * np.sign(w)) @ v.T, atol=1e-12)


VECTORS = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(DoubleType())), StructField("label", LongType()), StructField("n", StringType())])


def _whitened(rows, leading=8):
    """(x, S, components' eigenvalues and vectors) in plain numpy."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    size = max(Counter(len(v) for _, v in good).items(), key=lambda kv: (kv[1], kv[0]))[0]
    good = [(i, v) for i, v in good if len(v) == size]
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in good])
    z = x - x.sum(0) / len(x)
    values, vectors = np.linalg.eigh(z.T @ z / len(x))
    return [i for i, _ in good], x, z, values[::-1][:leading], vectors[:, ::-1][:, :leading], values.sum()


def _check_whitening(got, rows):
    ids, x, z, values, vectors, trace = _whitened(rows)
    k, n = len(values), len(x)
    got = sorted(got, key=lambda r: (r["deviation"], r["component"]))
    assert len(got) == n * k and {r["component"] for r in got} == set(range(1, k + 1))
    exact = [sum((n * int(c) - s) ** 2 for c, s in zip(row, x.sum(0).tolist())) for row in x]
    assert sorted((str(r["vec_id"]), r["deviation"]) for r in got if r["component"] == 1) == sorted(zip(map(str, ids), exact))
    assert {r["n"] for r in got} == {n} and all(r["identity_error"] < 1e-10 for r in got)
    for c in range(k):
        part = [r for r in got if r["component"] == c + 1]
        assert abs(part[0]["explained"] - values[c] / trace) < 1e-12
        if len(np.flatnonzero(np.abs(values - values[c]) < 1e-6 * values[0])) == 1:
            want = np.abs(z @ vectors[:, c] / math.sqrt(values[c]))
            assert np.allclose(np.sort([abs(r["whitened"]) for r in part]), np.sort(want), atol=1e-9)


def test_whitening_of_the_small_table(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf, "embeddings").collect()]
    _check_whitening(QUERIES["op12_whitening"](spark, sf).collect(), rows)


def test_whitening_leaves_out_what_is_not_whole(spark):
    rnd = random.Random(6)
    rows = [(i, [rnd.gauss(0, 1 + j) for j in range(10)]) for i in range(80)]
    rows += [(1, rows[1][1]), (None, rows[2][1]), (90, None), (91, []), (92, [None] * 10), (93, [float("nan")] * 10), (94, [1.0] * 9 + [math.inf]), (95, [1.0] * 4)]
    df = spark.createDataFrame([(i, v, 1, "clash") for i, v in rows], VECTORS).repartition(5)
    _check_whitening(whitening.whitening_report(df).collect(), rows)


def test_whitening_without_variance(spark):
    def report(rows):
        return whitening.whitening_report(spark.createDataFrame([(i, v, 1, "") for i, v in rows], VECTORS)).collect()

    assert report([]) == [] and report([(1, None), (2, [])]) == []
    same = report([(i, [0.5, 0.25, 1.0]) for i in range(9)])
    assert len(same) == 27 and all((r["deviation"], r["whitened"], r["explained"], r["identity_error"]) == (0, None, None, None) for r in same)
    line = report([(i, [float(i), 0.0, -float(i)]) for i in range(9)])
    first = [r for r in line if r["component"] == 1]
    assert abs(sum(r["whitened"] ** 2 for r in first) / 9 - 1) < 1e-12 and abs(first[0]["explained"] - 1) < 1e-12
    assert all(r["whitened"] is None and r["explained"] < 1e-12 for r in line if r["component"] > 1)
    with pytest.raises(Exception, match="2\\*\\*42"):
        report([(1, [1e30])])


def test_whitening_in_exact_numbers():
    mean = whitening.Mean(1 << 30, [5 << 34, -(3 << 33)])
    x = np.array([[1 << 40, -(1 << 39)], [7, 0]], np.int64)
    assert [[int(c) for c in row] for row in mean.spread(x)] == [[(1 << 70) - (5 << 34), -(1 << 69) + (3 << 33)], [(7 << 30) - (5 << 34), 3 << 33]]
    with pytest.raises(ValueError, match="long"):
        mean.deviation(mean.spread(x))


def test_token_counts_of_the_small_table(spark, sf, libraries):
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    want = [(i, len((t or "").encode()), k := len(libraries[2].encode(t or "", add_special_tokens=False).ids), k > 2048) for i, t in rows]
    assert _by_id(QUERIES["op13_token_counts"](spark, sf).collect()) == _by_id(want)


def test_token_counts_of_odd_rows(spark, documents, libraries):
    rnd, library = random.Random(7), libraries[2]
    special = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endoftext"]
    rows = ODD + [(100 + i, "".join(rnd.choice(special) if rnd.random() < 0.05 else rnd.choice("aAbB'sS tΣσςİ éé漢́̇\x1c\x85 ᠎1२<|>\U00032808Ɤ") for _ in range(rnd.randrange(40))))
                  for i in range(1500)]
    want = [(i, len((t or "").encode()), k := len(library.encode(t or "", add_special_tokens=False).ids), k > 60) for i, t in rows]
    assert _by_id(pair_counts.count_report(documents(rows, **CLASH), vocabulary(W), limit=60).collect()) == _by_id(want)
    assert pair_counts.token_counts(documents(rows[:3], **CLASH), vocabulary(W)).select("row.*").columns == ["doc_id", "text", "lang", "source", "n_chars", *CLASH]
    assert pair_counts.count_report(documents([]), vocabulary(W)).count() == 0


def test_counts_of_one_long_word_and_of_every_character(libraries):
    ours, library = pair_counts.counter(vocabulary(W)), libraries[2]
    long = "".join(random.Random(8).choice("abcdef") for _ in range(20_000))
    assert ours.count(long) == len(library.encode(long, add_special_tokens=False).ids)
    points = [c for c in range(0, 0x110000, 1 if os.environ.get("EVERY") else 17) if not 0xD800 <= c < 0xE000]
    texts = ["a" + chr(c) + "b's " + chr(c) + chr(c) for c in points]
    want = [len(e.ids) for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    assert [c for c, t, n in zip(points, texts, want) if ours.count(t) != n] == []


def test_other_vocabulary_files_are_refused():
    with pytest.raises(ValueError, match="word vocabulary"):
        pair_counts.WordCounter(vocabulary(A))
