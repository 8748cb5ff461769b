"""Tokens, quality, licences, toxicity, pages and archives."""

import base64
import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millwatch.llm import bpe, extract, huffman, licences, outliers, store, text_stats, token_files, toxicity, warc
from millwatch.llm.queries import QUERIES, pretoken_pattern, vocabulary
from millwatch.llm.store import arrow_schema, folder, table

CLASH = {"id": 1, "row": 2, "g": "x", "x0": 1.0, "ids": "y", "n_words": 3, "payload": "z"}
ODD = [None, "", " ", "  a  b ", "\n\n x\t", "a" * 3000, "naïve café 漢字 🎉 \x1c\x85", "don't I'LL <|endoftext|>", "1234567 $$$ ...", "x " * 2000]


def test_bpe_equals_tiktoken(spark, documents):
    import tiktoken

    path, pattern = vocabulary("byte_bpe_50k.tiktoken"), pretoken_pattern()
    ours = bpe.coder(path, pattern)
    theirs = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    rnd = random.Random(0)
    for _ in range(800):
        text = "".join(rnd.choice("aabcdeit  \n'.s!01é漢🎉") for _ in range(rnd.randrange(60)))
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == theirs.encode_ordinary(text), text
    rows = list(enumerate(ODD)) + [(3, ODD[3]), (None, "null id")]
    got = bpe.token_report(documents(rows, **CLASH), path, pattern).collect()
    want = sorted(((i is None, i or 0), len(e := theirs.encode_ordinary(t or "")), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert sorted(((r[0] is None, r[0] or 0), *r[1:]) for r in map(tuple, got)) == want
    assert bpe.token_report(documents([]), path, pattern).count() == 0


def _white_space_texts():
    rnd = random.Random(9)
    fixed = ["a \u00a0 \u00a0 c", "end. \u00a0 \u00a0", " \u00a0 \u00a0" * 4, "a\t \tb \n c", "x \u3000 \u2028 y ", "a \x1c b \u180e c", " \n "]
    return fixed + ["".join(rnd.choice("ab. \u00a0 \t\n\r\u3000\x1c\u180e") for _ in range(rnd.randrange(24))) for _ in range(1500)]


def test_bpe_of_single_spaces_beside_other_white_space():
    import tiktoken

    path, pattern = vocabulary("byte_bpe_50k.tiktoken"), pretoken_pattern()
    ours = bpe.BytePairs(bpe.load_ranks(path), pattern)
    theirs = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    for text in _white_space_texts():
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == theirs.encode_ordinary(text), repr(text)


def test_token_files_of_single_spaces_beside_other_white_space():
    library = token_files.library(vocabulary("byte_bpe_50k.json"))
    texts = _white_space_texts()
    for text, ids in zip(texts, library.encode(texts), strict=True):
        assert ids == library.whole([text])[0], repr(text)


def test_token_files_ask_the_library_for_each_part_once(monkeypatch):
    library = token_files._Library(vocabulary("byte_bpe_50k.json"))
    rnd, asked, whole = random.Random(8), [], library.whole
    pieces = ["one", "Two", "é", "3", ".", ",", "!?", ";", "'s", "\n", " ", "  ", "\n\n", "\u2028", "\u2009", "\x85", "\x1c", "漢", "\x00", "Ġ", "<|endoftext|>", "x" * 70]
    texts = ["", *("".join(rnd.choice(pieces) for _ in range(rnd.randrange(30))) for _ in range(1500)), ""]
    assert library.encode(texts) == whole(texts)
    assert library.encode([]) == [] and library.encode(["", ""]) == [b"", b""]

    library.forget()
    monkeypatch.setattr(library, "whole", lambda some: asked.extend(some) or whole(some))
    words = [f"w{a}{b}" for a in "abcdefghij" for b in "abcdefghij"]
    texts = [" ".join(words), ", ".join(words) + ".", ".\n".join(words)]
    assert library.encode(texts) == whole(texts)
    # each word behind a space or on a line of its own, each mark
    assert sum(map(len, asked)) < 2.2 * len(" ".join(words)) and max(map(len, asked)) < 1000


def _encoded(schema, texts, end_id=0):
    batch = pa.record_batch({"id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.binary())})
    batches = [batch.slice(k, 7) for k in range(0, len(texts), 7)]
    rows = [r for b in token_files._tokens(schema, vocabulary("byte_bpe_50k.json"), end_id, iter(batches)) for r in b.to_pylist()]
    return [(r["id"], np.frombuffer(r["ids"], f"<u{r['width']}").tolist()) for r in rows[:-1]], np.frombuffer(rows[-1]["counts"], "<i8")


def test_token_files_remember_parts_from_task_to_task(spark, monkeypatch):
    schema, library, asked = arrow_schema(token_files.ENCODED), token_files.library(vocabulary("byte_bpe_50k.json")), []
    whole = library.whole
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice(["w", "Wé", "verylongword"]) + str(rnd.randrange(40)) + rnd.choice(["", ",", "%%"]) for _ in range(60)) for _ in range(30)]
    rows = [t.encode() for t in texts] + [None, b"", b"bad \xff byte\xc3", b"\xa9 next"]
    want = [np.frombuffer(x, library.kind).tolist() for x in whole([*texts, "", "", "bad \ufffd byte\ufffd", "\ufffd next"])]
    monkeypatch.setattr(library, "whole", lambda some: asked.extend(some) or whole(some))
    library.forget()
    for end_id in (0, 70_000):  # the latter needs wider numbers
        got, counts = _encoded(schema, rows, end_id)
        assert got == [(k, [*ids, end_id]) for k, ids in enumerate(want)]
        assert (counts == np.bincount([i for _, ids in got for i in ids])).all()
        assert bool(asked) == (end_id == 0)  # the second task has met all parts
        asked.clear()
    # however few are remembered, ids are right
    monkeypatch.setattr(token_files, "REMEMBERED", 20)
    monkeypatch.setattr(token_files, "BATCH_BYTES", 500)
    for _ in range(2):
        assert _encoded(schema, rows)[0] == [(k, [*ids, 0]) for k, ids in enumerate(want)]
        assert len(library.short.parts) <= 20 and len(library.long.parts) <= 20
    assert _encoded(schema, [])[0] == []
    library.forget()


def test_token_files_cut_between_letters_and_punctuation(monkeypatch):
    library, asked = token_files._Library(vocabulary("byte_bpe_50k.json")), []
    whole = library.whole
    letters = [chr(c) for c in (*range(0x21, 0x7F), *range(0xA0, 0x180), *range(0x3F0, 0x490), 0x2C2, 0x4E00)]
    texts = [f"{a}{b} x{a}{b}{b}{a} {b}{a}'s" for a in letters for b in "',%_"]
    assert library.encode(texts) == whole(texts)
    monkeypatch.setattr(library, "whole", lambda some: asked.extend(some) or whole(some))
    library.forget()
    words = [f"w{a}\u00e9" for a in "abcdefghij"]
    library.encode([w + end for w in words for end in "%&*_'#$"])
    assert sum(map(len, asked)) < 2 * len(" ".join(words))


def test_huffman_blocks_are_decoded_together():
    counts = np.arange(1, 400) ** 2
    lengths = huffman.code_lengths(counts)
    codes, decode, rnd = huffman.canonical(lengths), huffman.Decoder(lengths), np.random.default_rng(3)
    blocks = [rnd.choice(len(counts), n, p=counts / counts.sum()).astype(np.uint32) for n in (640, 1, 0, 64, 63, 65, 1000)]
    coded = [(data, len(b), marks.astype(np.int64)) for b in blocks for data, marks in [huffman.encode(b, lengths, codes)]]
    assert (decode.several(coded) == np.concatenate(blocks)).all()
    assert all((decode(*c) == b).all() for c, b in zip(coded, blocks, strict=True))


def test_bpe_of_a_long_pre_token():
    ours = bpe.coder(vocabulary("byte_bpe_50k.tiktoken"), pretoken_pattern())
    text = "".join(random.Random(1).choice("abcdef") for _ in range(30_000))
    assert ours.decode(ours.encode(text)) == text.encode()


def test_rank_order_and_stale_entries():
    small = bpe.BytePairs({b"a": 0, b"b": 1, b"ab": 2, b"aab": 3, b"ba": 4, b"c": 5}, r".+")
    # leftmost of equal ranks first; entries of parts that have merged are void
    assert [small.bytes_of[i] for i in small.merge(b"aababac")] == [b"aab", b"ab", b"a", b"c"]


@pytest.mark.parametrize(("n", "limit"), [(1, 4), (2, 2), (37, 6), (500, 9), (5000, 20)])
def test_huffman_round_trip_and_limit(n, limit):
    counts = (1e6 / np.arange(1, n + 1) ** 1.3).astype(np.int64) + 1
    lengths = huffman.code_lengths(counts, limit)
    assert lengths.max() <= limit and (0.5 ** lengths[lengths > 0].astype(float)).sum() <= 1 + 1e-12
    ids = np.random.default_rng(n).choice(n, 1001, p=counts / counts.sum()).astype(np.uint32)
    data, marks = huffman.encode(ids, lengths, huffman.canonical(lengths))
    assert (huffman.Decoder(lengths)(data, len(ids), marks.astype(np.int64)) == ids).all()


def test_huffman_is_optimal_without_a_binding_limit():
    import heapq

    counts = np.random.default_rng(2).integers(1, 1000, 60)
    heap = [int(c) for c in counts]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        heapq.heappush(heap, x := heapq.heappop(heap) + heapq.heappop(heap))
        total += x
    assert int((counts * huffman.code_lengths(counts)).sum()) == total


def test_token_files_hold_what_the_library_says(spark, documents, monkeypatch):
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    rows = list(enumerate(ODD)) + [(100 + k, f"text number {k} of many") for k in range(50)] + [(3, ODD[3])]
    got = sorted(tuple(r) for r in token_files.token_file_report(documents(rows, **CLASH), path).collect())
    start, want = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want
    assert token_files.token_file_report(documents([]), path).count() == 0


def test_a_damaged_token_file_is_an_error(spark, documents):
    uri = folder(spark, "damaged")
    token_files.write_ids(documents([(1, "some text")]), vocabulary("byte_bpe_50k.json"), uri)
    from millwatch.llm.store import open_store

    store, path = open_store(uri)
    from pyarrow import fs

    name = next(f.path for f in store.get_file_info(fs.FileSelector(path)) if f.path.endswith(".mwt"))
    data = bytearray(store.open_input_stream(name).read())
    assert list(token_files.read_file(bytes(data)))
    (codes,) = np.frombuffer(data, "<u4", 1, 12)
    data[16 + int(codes) + 18] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        list(token_files.read_file(bytes(data)))


def _base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = {g for g in grams if grams.count(g) > 1}
    hit = {k + d for k, g in enumerate(grams) if g in often for d in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_base_counts_equal_plain_python():
    texts = [*ODD[:5], "a b c a b c\na b c\n\na b c\n x", "## é|é\r\né|é\n##", "one", "p q r s p q r"]
    got = text_stats.counts_of([(t or "").encode() for t in texts])
    for k, t in enumerate(texts):
        assert tuple(int(got[c][k]) for c in ("n_words", *outliers.COUNTS)) == _base(t), t


def test_outliers_are_rejected_and_clean_texts_kept(spark, documents):
    rnd = random.Random(3)
    clean = lambda: " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 9))) for _ in range(rnd.randrange(60, 200)))
    junk = lambda: re.sub(" ", "## $$ ", clean())
    rows = [(i, clean()) for i in range(300)] + [(1000 + i, junk()) for i in range(60)] + [(2000, None), (2001, ""), (2002, "few words"), (2003, "same words here " * 100), (0, rows0 := clean())]
    docs = documents(rows, **CLASH).withColumn("source", F.when(F.col("doc_id") < 200, "hot").when(F.col("doc_id") < 205, None).otherwise("other"))
    got = {(r["doc_id"], r["n_words"]): r for r in outliers.quality_report(docs).collect()}
    assert len(got) >= len(rows) - 1 and rows0
    for (i, _), r in got.items():
        assert r["kept"] == (i < 1000), r
        assert r["base_failed"] == (i >= 2000)
    kept = outliers.keep_quality(docs)
    assert kept.columns == docs.columns and kept.count() == 301


def test_outliers_without_sound_texts(documents):
    assert outliers.quality_report(documents([(1, None), (2, "x")])).where("kept").count() == 0
    assert outliers.quality_report(documents([])).count() == 0


def test_determinant_estimate_ignores_a_cloud(spark):
    rng = np.random.default_rng(0)
    good = rng.normal(0, 1, (900, 4)) * [1, 2, 0.5, 1] + [5, 0, 1, 2]
    bad = rng.normal(0, 0.1, (150, 4)) + [30, 30, 30, 30]
    rows = spark.createDataFrame([("g", *map(float, v)) for v in np.concatenate([good, bad])], "g string, x0 double, x1 double, x2 double, x3 double")
    fit = outliers.estimate(rows).first()
    assert np.abs(np.array(fit["centre"]) - good.mean(axis=0)).max() < 0.2
    spread = np.linalg.inv(np.array(fit["inverse"]).reshape(4, 4))
    assert np.allclose(np.sqrt(np.diag(spread)), [1, 2, 0.5, 1], rtol=0.12)


def test_chi_square_quantiles():
    assert abs(outliers.quantile(0.975) - 11.143) < 1e-2 and abs(outliers.quantile(0.75) - 5.385) < 1e-2
    assert abs(outliers._below(outliers.cut(1e-3), 4) - 0.999) < 1e-9


def test_licences_equal_comparing_with_every_template(documents):
    scanner = licences.Scanner()
    mit = licences.TEMPLATES["MIT#grant"]
    texts = [
        "Words.\nReleased under the MIT License.\nmore", "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0.", "x\n" + mit.replace("copies", "clones") + "\ny",
        "the licence of a driver is a permission", "All rights reserved.", "This work is licensed under the GNU General Public License, version 2.", None, "", "licensed under cc by 5.0", "a " * 20_000 + "\nReleased under the MIT License.",
    ]
    got = {r["doc_id"]: r for r in licences.licence_report(documents(list(enumerate(texts)), **CLASH)).collect()}

    def brute(text):
        out = set()
        for line in (text or "").split("\n"):
            if not licences._TRIGGER.search(line):
                continue
            scored = []
            for k in licences.TEMPLATES:
                cover, off = scanner.differences(line, k)
                if cover >= licences.COVER and len(off) <= (licences.DIFFER if len(scanner.words[k]) > 12 else 0):
                    scored.append((len(off), -len(scanner.words[k]), k))
            if scored:
                out.add(min(scored)[2].split("#")[0])
        return ",".join(sorted(out))

    for i, t in enumerate(texts):
        assert got[i]["licences"] == brute(t), (t or "")[:60]
    assert got[2]["licences"] == "MIT" and got[2]["n_differences"] > 0 and got[3]["licences"] == ""


def test_every_licence_of_a_text_is_found(documents):
    mit, apache, bsd = (licences.TEMPLATES[k] for k in ("MIT#grant", "Apache-2.0#header", "BSD-3-Clause"))
    wrap = lambda t: re.sub(r"((?:\S+ ){8})", r"\1\n", t)
    prose = "the copying of words is free to all who read and write them in a general way and so on " * 6
    texts = [
        ("Licensed under the Apache License, Version 2.0. Released under the MIT License.", "Apache-2.0,MIT", 0),
        (wrap(mit.replace("copies", "clones")) + "\n" + wrap(bsd.replace("binary", "object", 1)), "BSD-3-Clause,MIT", 6),
        (prose + mit + " " + prose + bsd + " All rights reserved. " + prose + "Licensed under CC BY 4.0.", "BSD-3-Clause,CC-BY-4.0,MIT,Proprietary", 0),
        (prose + "the general copying of software is permitted. All rights reserved. " + prose, "Proprietary", 0),
        ("All rights\nreserved.", "Proprietary", 0),
        (wrap(apache).replace("Licensed under", "Licenced under") + " " + prose, "Apache-2.0", 1),
        (mit.replace("FITNESS", "USE").replace("merge", "join") + " " + prose, "MIT", 4),
        (mit.replace("to", "too"), "", 0),
        (("Released under the MIT License. " + prose) * 3, "MIT", 0),
    ]
    got = {r["doc_id"]: r for r in licences.licence_report(documents([(i, t) for i, (t, _, _) in enumerate(texts)])).collect()}
    for i, (t, want, off) in enumerate(texts):
        assert (got[i]["licences"], got[i]["n_differences"]) == (want, off), t[:80]
    found = licences.Scanner().scan("x\n" + texts[1][0])[1]
    assert [f[2] for f in found] == ["MIT#grant", "BSD-3-Clause"] and found[0][0] == 1
    assert len(licences.Scanner().scan(texts[8][0])[1]) == 3


def test_licences_are_confirmed_in_the_order_of_compression():
    header = licences.TEMPLATES["Apache-2.0#header"]
    # the whole header saves more than its first sentence, which has no difference
    scanner = licences.Scanner()
    assert [(f[2], f[4]) for f in scanner.scan(header.replace("obtain", "get"))[1]] == [("Apache-2.0#header", ["-obtain", "+get"])]
    # every block is compressed with every template, and what is left of it again
    scanner, asked = licences.Scanner(), []
    scanner.reductions = lambda passage, names: asked.append((passage, len(names))) or [float(n == "MIT") for n in names]
    assert scanner.scan("my licence\n\n\n\n\nReleased under the MIT License. thanks")[0] == 2
    ranked = [a for a in asked if a[1] > 1]
    assert ranked[0] == ("my licence", 20) and ranked[1] == ("released under the mit license thanks", 20) and ranked[2] == ("thanks", 19)
    # templates that save alike: the wording decides
    for name in ("GPL-2.0", "GPL-3.0", "LGPL-3.0", "AGPL-3.0"):
        found = licences.Scanner().scan("All of it. " + licences.TEMPLATES[name] + " " + "plain words follow " * 30)[1]
        assert [(f[2], f[4]) for f in found] == [(name, [])]
    # a notice broken over many lines goes beyond its block
    assert [f[2] for f in licences.Scanner().scan(header.replace(" ", "\n"))[1]] == ["Apache-2.0#header"]


def test_toxicity_on_held_out_rows(spark, sf):
    sf = sf.replace("sf0.001", "sf0.1")
    labels = table(spark, sf, "labels")
    got = QUERIES["op8_toxicity"](spark, sf)
    assert got.where("score is null or score < 0 or score > 1 or predicted <> int(score >= 0.5)").count() == 0
    seen = got.where("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in seen}
    right, missed, wrong = n.get((1, 1), 0), n.get((1, 0), 0), n.get((0, 1), 0)
    assert right and right >= 0.9 * (right + missed) and right >= 0.9 * (right + wrong)


def test_toxic_words_in_disguise(spark, documents):
    rnd = random.Random(6)
    words = ["".join(rnd.choice(("ba", "del", "ri", "mo", "ten", "su", "la")) for _ in range(4)) for _ in range(1500)]
    text = lambda *bad: " ".join([*(rnd.choice(words) for _ in range(30)), *bad])
    rows = [(i, text(*(["scoundrel"] if i % 4 == 0 else []))) for i in range(400)]
    docs = documents(rows, **CLASH)
    labels = spark.createDataFrame([(i, 0, int(i % 4 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    lexicon = toxicity.learn(docs, labels)
    probe = [(1, text("sc0undrel")), (2, text("s.c.o.u.n.d.r.e.l")), (3, text("scouuundrel")), (4, text("s c o u n d r e l")), (5, text("$coundr3l")), (6, text("2nd", "a.m.", "t0")), (7, None), (8, ""), (9, text("x" * 5000))]
    got = {r[0]: r[1] for r in toxicity.score_texts(documents(probe), lexicon, ["doc_id"]).select("row.doc_id", "score").collect()}
    assert all(got[i] >= 0.5 for i in range(1, 6)), got
    assert all(got[i] < 0.5 for i in range(6, 10)), got


def test_long_and_spaced_disguises(spark, documents):
    rnd = random.Random(6)
    words = ["".join(rnd.choice(("ba", "del", "ri", "mo", "ten", "su", "la")) for _ in range(4)) for _ in range(1500)]
    text = lambda *bad: " ".join([*(rnd.choice(["a", "i", *rnd.sample(words, 8)]) for _ in range(30)), *bad])
    rows = [(i, text(*(["scoundrel", "knave"] if i % 4 == 0 else []))) for i in range(400)]
    labels = spark.createDataFrame([(i, 0, int(i % 4 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    lexicon = toxicity.learn(documents(rows, **CLASH), labels)
    signs = ["sc" + "o" * 70 + "undrel", "s.-c.-o.-u.-n.-d.-r.-e.-l" + "." * 3 + "-" * 60 + "x", "what a s c o u n d r e l", "k n a v e s c o u n d r e l", "i s c o u n d r e l.", "y s.c.o.u.n.d.r.e.l", "a k n a v e"]
    rest = ["a b c d e", "x" * 5000, "a i " * 50, "b a d e l r i m o"]
    probe = [(k, text(t)) for k, t in enumerate(signs + rest)]
    got = {r[0]: r[1] for r in toxicity.score_texts(documents(probe), lexicon, ["doc_id"]).select("row.doc_id", "score").collect()}
    assert all((got[k] >= 0.5) == (k < len(signs)) for k in got), got


def test_toxicity_without_labels(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["predicted"] for r in toxicity.toxicity_report(documents([(1, "a"), (None, None)]), labels).collect()] == [0, 0]
    assert toxicity.toxicity_report(documents([]), labels).count() == 0


def test_messages_give_exact_marginals():
    tree = extract.Tree("<body><div>one<p>two</p></div><nav>three</nav></body>")
    f, model = extract.Forest([tree]), extract.Model()
    n = len(f.parent)
    own = np.zeros((n, 2))
    own[:, 1] = f.x @ model.weights
    total, mass = 0.0, np.zeros(n)
    for bits in range(1 << n):
        y = [(bits >> k) & 1 for k in range(n)]
        score = sum(own[k, y[k]] for k in range(n)) + sum(model.log_ties[0 if f.wrapper[f.parent[k]] else 1, y[f.parent[k]], y[k]] for k in range(n) if f.parent[k] >= 0)
        total += np.exp(score)
        mass += np.exp(score) * np.array(y)
    assert np.allclose(mass / total, model.marginals(f))


def test_pages_keep_the_article(spark, sf):
    pages = table(spark, sf, "pages")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    got = {r["page_id"]: r for r in QUERIES["op9_extract"](spark, sf).collect()}
    assert len(got) == len(html)
    import html as entities

    for i, page in html.items():
        inside = re.sub(r"<!--.*?-->", "", re.search(r"<article>(.*?)</article>", page, re.S)[1], flags=re.S)
        parts = [" ".join(entities.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)[^>]*>", inside)]
        assert got[i]["text"] == " ".join(p for p in parts if p) and got[i]["n_chars"] == len(got[i]["text"])


def test_odd_pages(spark):
    long = "This is a paragraph of some length, with commas and stops. It says a thing or two. "
    page = f"<div class='menu'><a>Home</a></div><div id=post-body><h2>Title</h2><p>{long}</p><div class=ad>Buy this now.</div><p>A&amp;B {long}<script>x='<p>'</script></p></div><div id=comments><p>{long}</p></div><form>Send <button>ok</button></form>"
    rows = [(1, "u", page), (2, "u", None), (3, None, ""), (4, "u", "<"), (5, "u", "<p " + "x='" * 3000), (None, "u", "<script>never closed"), (1, "u", page), (6, "u", "<div>" * 3000 + long)]
    got = extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string"), extract.Model()).collect()
    assert len(got) == len(rows)
    text = {r["page_id"]: r["text"] for r in got}
    assert text[1] == " ".join(f"Title {long} A&B {long}".split())
    assert text[2] == text[3] == text[None] == ""
    assert extract.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("size", [3000, 5000, 400_000])
def test_attribute_values_of_any_length(size):
    texts = lambda page: [t for t in extract.Tree(page).text if t]
    for quote in "\"'":
        assert texts(f"<div data-x={quote}{'a>b<i>' * (size // 6)}{quote} class=c>real</div>") == ["real"]
        assert texts(f"<p>a</p><iframe srcdoc={quote}{'<p>x</p>' * (size // 8)}{quote}>y</iframe><p>b</p>") == ["a", "b"]


def test_archives_round_trip(spark):
    rows = [(5, "http://b/1", "<p>é</p>"), (2, "http://a/1", "<p>é</p>"), (7, "http://a/1", None), (3, None, ""), (9, "http://c/ x\n", "z" * 200_000), (2, "http://a/1", "<p>é</p>"), (None, "u", "<p>é</p>"), (None, "v", "only")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(v) for c, v in CLASH.items()})
    uri = folder(spark, "warc")
    manifest = warc.write_warc(pages, uri, roll=300)
    assert manifest.count() > 1 and manifest.agg(F.sum("records")).first()[0] == len(rows)
    got = warc.read_warc(manifest, uri).collect()
    assert len(got) == len(rows)
    for r in got:
        payloads = {(h or "").encode() for i, _, h in rows if i == r["page_id"]}
        assert r["payload_bytes"] in {len(p) for p in payloads}
        assert r["payload_digest"] in {base64.b32encode(hashlib.sha1(p).digest()).decode() for p in payloads}
    kinds = sorted((r["page_id"] or -1, r["record_type"], r["refers_to"]) for r in got)
    assert kinds == [(-1, "response", None), (-1, "revisit", 2), (2, "response", None), (2, "response", None), (3, "response", None), (5, "revisit", 2), (7, "revisit", 3), (9, "response", None)]
    again = warc.write_warc(pages, folder(spark, "warc"), roll=300)
    names = lambda m: sorted(tuple(r) for r in m.select("name", "sha256").collect())
    assert names(manifest) == names(again)
    assert warc.warc_report(pages.limit(0)).count() == 0


def test_archive_workers_hold_one_payload_and_give_memory_back(spark, tmp_path, monkeypatch):
    n, size = 400, 50_000
    columns = {"url": [f"http://a/{i:04}" for i in range(n)], "id": range(n), "same": ["s"] * n, "refers": [None] * n, "refers_url": [None] * n, "payload": [bytes([i % 251]) * size for i in range(n)]}
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    batch = pa.record_batch([pa.array(v, t) for v, t in zip(columns.values(), types, strict=True)], names=list(columns))
    del columns
    tracemalloc.start()
    done = list(warc._write(arrow_schema(warc.WRITTEN), str(tmp_path), warc.ROLL_BYTES, iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert done[0]["records"].to_pylist() == [n] and peak < n * size // 4

    calls, tables, saved = [], [], store.saved
    monkeypatch.setattr(warc, "Tidy", lambda fn: calls.append(fn.func.__name__) or store.Tidy(fn))
    monkeypatch.setattr(store, "saved", lambda df, name: tables.append(name) or saved(df, name))
    pages = spark.createDataFrame([(i, f"http://a/{i}", "x" * i) for i in range(40)], "page_id long, url string, html string")
    uri = folder(spark, "warc")
    manifest = warc.write_warc(pages, uri, roll=1)
    assert warc.read_warc(manifest, uri).count() == 40
    assert calls == ["_write", "_read"]
    # each file that Spark writes starts processes of the executor, so the manifest of 40 archives is one file
    assert manifest.count() == 40 and len(manifest.inputFiles()) == 1
    assert tables == ["written", "manifest"]


def test_no_page_or_token_takes_more_than_its_length():
    import time

    from millwatch.llm import deobfuscate
    from millwatch.llm.html_tree import Tree

    for html in ("<a " * 350_000, "<script " * 150_000, "<!" * 500_000, '<a "' * 250_000, "<b>x</b>" + "<!--" * 250_000, "<a '\"" * 200_000 + ">"):
        began = time.perf_counter()
        Tree(html)
        assert time.perf_counter() - began < 5, html[:20]
    model = deobfuscate.CharacterModel(*np.unique(deobfuscate.trigram_codes("the quick brown fox is a fool " * 50), return_counts=True))
    began = time.perf_counter()
    deobfuscate.readings("a" + "*#" * 50_000 + "b", model)
    assert time.perf_counter() - began < 5
    assert "fool" in deobfuscate.readings("f**l", model)


@pytest.mark.parametrize("html, texts", [
    ("<p>a <b", ["a <b"]), ("<p>a<!-- c", ["a"]), ("<p>a<!-- c --><i>b</i> t", ["a", "b", " t"]), ("<p>a<script>x > y", ["a"]), ("<!-- > x", []),
    ("<p>a<script>x</script>b", ["a", "b"]), ("a > b < c", ["a > b < c"]), ("no tags", ["no tags"]), ("", []), ("a<!-->b", ["a"]), ("<script>x</script", []),
])
def test_ends_of_pages(html, texts):
    from millwatch.llm.html_tree import TEXT, Tree

    tree = Tree(html)
    assert [t for t, tag in zip(tree.text, tree.tag, strict=True) if tag == TEXT] == texts


def test_regular_words_have_fingerprints_of_their_own():
    """A Thue-Morse word and its complement are one polynomial modulo 2**64, whatever the base."""
    from millwatch.llm import octets

    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    o = octets.Octets([word.encode(), other.encode()])
    assert len(set(octets.segment_hash(o.data, o.starts, o.ends).tolist())) == 1
    assert len(set(octets.content_hash(o.data, o.starts, o.ends).tolist())) == 2
    rnd = random.Random(3)
    texts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(40))) for _ in range(3000)] + [b"", b"\x00", b"\x00\x00", b"\x00" * 8, b"\x00" * 9, b"a" * 8, b"a" * 16]
    o = octets.Octets(texts)
    assert len(set(octets.content_hash(o.data, o.starts, o.ends).tolist())) == len(set(texts))


def test_regular_lines_and_words_in_operators(spark, documents):
    from millwatch.llm import near_dup

    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    report = outliers.quality_report(documents([(1, f"{word}\n{other}"), (2, f"{word}\n{word}")])).collect()
    assert {r["doc_id"]: r["n_dup_lines"] for r in report} == {1: 0, 2: 1}
    near = near_dup.near_dup_report(documents([(1, word), (2, other), (3, word)])).collect()
    assert {r["doc_id"]: r["component_id"] for r in near} == {1: 1, 2: 2, 3: 1}
