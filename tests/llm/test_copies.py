"""Near copies, repeated strings and leaks against brute force."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from millwatch.llm import decontaminate, near_dup, store, suffix_dedup
from millwatch.llm.components import components
from millwatch.llm.store import table
from millwatch.llm.superminhash import signatures

CLASH = {"id": 1, "spans": "x", "row": 2, "bands": 3, "key": 4, "kept": False, "a": 5}


def _sentence(rnd, n, words=400):
    return " ".join(f"w{rnd.randrange(words)}" for _ in range(n))


def _family(rnd):
    """Texts with near copies of several strengths, exact copies, ties, odd rows."""
    rows, i = [], 0
    for _ in range(12):
        base = _sentence(rnd, 80, 5000).split()
        for edits in (0, 0, 1, 2, 4, 8, 14):
            words = list(base)
            for _ in range(edits):
                words[rnd.randrange(len(words))] = f"x{rnd.randrange(10**6)}"
            rows.append((i, " ".join(words)))
            i += 1
    return [*rows, (i, None), (i + 1, ""), (i + 2, "  \n\t "), (i + 3, "One"), (i + 4, "one"), (i + 5, "a b"), (i + 6, "A  B"), (i + 7, "x " * 5000), (None, "one"), (3, rows[3][1])]


def _sets(rows, width):
    out = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    return out


def _groups(sets, percent):
    ids = sorted(sets, key=lambda i: (i is not None, i or 0))
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                if x != y:
                    first, second = sorted((x, y), key=ids.index)
                    parent[second] = first
    return {i: find(i) for i in ids}


@pytest.mark.parametrize(("width", "block"), [(2, 512), (2, 3), (5, 512)])
def test_near_duplicates_equal_all_pairs(documents, width, block):
    rows = _family(random.Random(width))
    sets = _sets(rows, width)
    want = _groups(sets, 80)
    got = near_dup.near_duplicates(documents(rows, **CLASH), width, 80, block=block).collect()
    assert len(got) == len(rows)
    name = lambda i: None if i == near_dup.NO_ID else i
    for r in got:
        assert r["n_shingles"] == len(sets[name(r["id"])])
        assert name(r["component"]) == want[name(r["id"])]


def test_one_of_each_group_stays_with_all_columns(documents):
    rows = [(i, t) for i, t in _family(random.Random(5)) if i is not None]
    docs = documents(rows, **CLASH)
    kept = near_dup.drop_near_duplicates(docs)
    want = _groups(_sets(rows, 5), 80)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({i for i in want if want[i] == i})
    assert kept.columns == docs.columns


def test_a_saved_table_leaves_no_shuffle_files(spark, monkeypatch):
    def files():
        names = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in names.split("\n") if re.search(r"/shuffle_\d+_", f)}

    monkeypatch.setattr(store, "_clean", lambda session: None)
    before = files()
    assert store.saved(spark.range(1000).repartition(3).groupBy(F.col("id") % 7).count(), "sevens").count() == 7
    until = time.monotonic() + 20
    # the count of the result has a shuffle of its own, of one row
    while (left := len({re.search(r"shuffle_(\d+)_", f)[1] for f in files() - before})) > 1 and time.monotonic() < until:
        time.sleep(0.2)
    assert left <= 1
    assert spark.conf.get(store.SHUFFLES_END, None) is None


def test_signatures_and_texts_are_not_shuffled_for_each_band(spark, documents, monkeypatch):
    tables = {}

    def saved(df, name):
        tables[name] = df.columns, df._jdf.queryExecution().toString()
        return store.saved(df, name)

    monkeypatch.setattr(near_dup, "saved", saved)
    rows = [(i, t) for i, t in dict(_family(random.Random(9))).items() if i is not None]
    near_dup.drop_near_duplicates(documents(rows)).count()
    assert tables["buckets"][0] == ["key", "tie", "id"]
    assert "sig" not in tables["buckets"][1].split("== Physical Plan ==")[1].replace("n_shingles", "")
    assert "Exchange hashpartitioning" not in tables["sets"][1].split("== Physical Plan ==")[1]


def _shared_ids():
    """Different texts of one id, and of no id: (doc_id, text), no row repeated."""
    rnd = random.Random(12)
    one, two, three, passage = (_sentence(rnd, 90, 9000) for _ in range(4))
    rows = [(None, one), (None, two), (None, three), (5, f"{two} {passage}"), (5, passage), (5, _sentence(rnd, 70, 9000)), (7, f"{three} more"), (8, f"{passage} end"), (5, "short"), (9, None), (9, "")]
    return rows + [(k, _sentence(rnd, 30, 9000)) for k in (5, 20, 20)]


def test_texts_that_share_an_id_are_documents_of_their_own(documents):
    rows = _shared_ids()
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, hashlib.sha256(rows[k][1].encode()).hexdigest() if rows[k][1] is not None else ""))
    keyed_rows = [(k, rows[i][1]) for k, i in enumerate(order)]
    groups = _groups(_sets(keyed_rows, 5), 80)
    want = sorted((repr(rows[i]) for k, i in enumerate(order) if groups[k] == k))
    docs = documents([*rows, rows[4], rows[0]], **CLASH)
    kept = near_dup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(repr((r["doc_id"], r["text"])) for r in kept.collect()) == want
    report = near_dup.near_dup_report(docs, 5).collect()
    assert len(report) == len(rows) + 2 and sum(r["kept"] for r in report) == len(want) + 2

    spans = _brute_spans(keyed_rows, 100)
    got = suffix_dedup.dedup_spans(documents([*rows, rows[4]])).collect()
    assert len(got) == len(rows) + 1
    number = {rows[i]: k for k, i in enumerate(order)}
    for r in got:
        assert (r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) == spans[number[r["row"]["doc_id"], r["row"]["text"]]]


def test_empty_tables(spark, documents):
    none = documents([])
    assert near_dup.near_dup_report(none).count() == 0
    assert suffix_dedup.dedup_report(none).count() == 0
    bench = spark.createDataFrame([], "item_id string, text string")
    assert decontaminate.leak_report(none, bench).count() == 0
    assert decontaminate.leak_report(documents([(1, "a b c")]), bench).first()["contaminated"] is False


def test_signatures_estimate_similarity():
    rnd = np.random.default_rng(3)
    pool = rnd.integers(0, 1 << 63, 4000, dtype=np.uint64)
    errors = []
    for k in range(60):
        a, b = pool[k * 10 : k * 10 + 100], pool[k * 10 + 25 : k * 10 + 125]
        s = signatures(np.concatenate([a, b]), np.repeat([0, 1], 100), 2)
        errors.append((s[0] == s[1]).mean() - 75 / 125)
    assert abs(np.mean(errors)) < 0.02
    # the correlated ranks vary less than independent hashes would
    assert np.std(errors) < 1.1 * (0.6 * 0.4 / 160) ** 0.5


def test_each_round_of_a_signature_is_a_permutation():
    one = np.array([123456789], np.uint64)
    rounds = signatures(one, np.zeros(1, np.int64), 1, 64)[0] >> np.uint64(32)
    assert sorted(rounds.tolist()) == list(range(64))


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(400)] + [(1000, 1002), (1001, 1002), (7, 7)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(401), 0), 1000: 1000, 1001: 1000, 1002: 1000}


def _brute_spans(rows, length):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if b[p : p + length] in seen:
                gone[p : p + length] = True
            seen.add(b[p : p + length])
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out[i] = (len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("group", [8000, 4])
def test_suffix_dedup_equals_brute_force(documents, group):
    rnd = random.Random(group)
    shared = [_sentence(rnd, 40, 9000) for _ in range(4)]
    rows = []
    for i in range(40):
        parts = [_sentence(rnd, rnd.randrange(5, 60), 9000) for _ in range(3)]
        parts.insert(rnd.randrange(3), rnd.choice(shared)[rnd.randrange(20) :])
        rows.append((i, "\n".join(parts)))
    rows += [(40, rows[7][1]), (41, rows[7][1]), (42, None), (43, ""), (44, "a" * 5000), (45, "b" + "a" * 700 + "ñ" * 300), (46, "short"), (47, "short"), (None, rows[3][1]), (48, "é" * 400), (49, rows[2][1] * 3)]
    want = _brute_spans(rows, 100)
    docs = documents(rows, **CLASH)
    spans, copies = suffix_dedup.repeated_spans(docs, group=group)
    assert copies.count() == 3
    if group == 4:
        return  # the parts of a split group are compared below, by the same brute force
    for r in suffix_dedup.dedup_report(docs).collect():
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]], r


def test_split_groups_give_the_same_spans(documents, monkeypatch):
    rnd = random.Random(8)
    passage = _sentence(rnd, 60, 9000)
    rows = [(i, f"{_sentence(rnd, 20, 9000)} {passage} {_sentence(rnd, 20, 9000)}") for i in range(30)]
    want = _brute_spans(rows, 100)
    split = suffix_dedup.repeated_spans

    monkeypatch.setattr(suffix_dedup, "repeated_spans", lambda docs, length: split(docs, length, group=4))
    for r in suffix_dedup.dedup_report(documents(rows)).collect():
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]], r


def test_long_texts_are_cut_into_pieces(documents, monkeypatch):
    rnd = random.Random(2)
    text = _sentence(rnd, 3000, 9000)
    rows = [(1, text), (2, text[5000:9000] + " end"), (3, text + "!")]
    want = _brute_spans(rows, 100)
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    for batch in ([b for b in (t.encode() for _, t in rows)],):
        parts, owner, offset = suffix_dedup._pieces(batch, 100)
        assert len(parts) > 20 and b"".join(p[: 901] for p, o in zip(parts, owner, strict=True) if o == 0)[:500] == batch[0][:500]
        assert offset[1] == 901
    for r in suffix_dedup.dedup_report(documents(rows)).collect():
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]]


def test_column_order_is_suffix_order():
    rnd = np.random.default_rng(1)
    columns = rnd.integers(0, 3, (12, 50)).astype(np.int16) + 1
    group = np.sort(rnd.integers(0, 4, 50))
    for c, order, common in suffix_dedup.sort_columns(columns, group):
        suffix = [(int(group[i]), *columns[c:, i].tolist()) for i in order]
        assert suffix == sorted(suffix)
        for k in range(1, 50):
            a, b = suffix[k - 1], suffix[k]
            n = 0
            while a[0] == b[0] and n + 1 < len(a) and a[n + 1] == b[n + 1]:
                n += 1
            assert common[k] == n


def _leaks(rows, items, window=10):
    w = lambda t: decontaminate.words((t or "").encode())
    wins = {}
    for name, t in items:
        seq = w(t)
        for k in range(max(1, len(seq) - window + 1) if seq else 0):
            wins.setdefault(tuple(seq[k : k + window]), set()).add(str(name))
    out = {}
    for i, t in rows:
        seq, hit, who = w(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(seq) - n + 1):
                if (x := tuple(seq[k : k + n])) in wins:
                    hit |= set(range(k, k + n))
                    who |= wins[x]
        out[i] = (len(seq), len(hit), len(who), hashlib.sha256(",".join(sorted(who)).encode()).hexdigest())
    return out


@pytest.mark.parametrize("parts", [1, 3])
def test_leaks_equal_brute_force(spark, documents, monkeypatch, parts):
    rnd = random.Random(4)
    items = [(k, _sentence(rnd, n, 12)) for k, n in enumerate((25, 14, 10, 9, 4, 2, 0, 30))] + [(8, None), (9, "Zebra"), (10, "W1, w2; w3 É"), (11, "W1, w2; w3 É")]
    rows = [(i, _sentence(rnd, rnd.randrange(0, 200), 12)) for i in range(30)] + [(30, None), (31, "zebra ZEBRA"), (32, items[0][1].upper() + "! x"), (33, "w1 w2 w3 É and w1 w2 w3 é"), (34, items[7][1] * 40), (None, items[1][1])]
    if parts > 1:
        monkeypatch.setattr(decontaminate, "PART_BYTES", 800)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = _leaks(rows, items)
    got = decontaminate.leak_report(documents(rows, **CLASH), bench).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == want[r["doc_id"]], r


@pytest.mark.parametrize("parts", [1, 3])
def test_an_item_in_several_rows_counts_once(spark, documents, monkeypatch, parts):
    rnd = random.Random(6)
    one, two = _sentence(rnd, 15), _sentence(rnd, 15)
    items = [(1, one), (1, one), (1, two), (2, two), (3, _sentence(rnd, 200))]
    rows = [(1, f"{one} x {two}"), (2, two), (3, "none")]
    if parts > 1:
        monkeypatch.setattr(decontaminate, "PART_BYTES", 800)
    want = _leaks(rows, items)
    for r in decontaminate.leak_report(documents(rows), spark.createDataFrame(items, "item_id long, text string")).collect():
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == want[r["doc_id"]], r


def test_removing_leaks(spark, documents):
    item = " ".join(f"t{k}" for k in range(12))
    clean = _sentence(random.Random(1), 60)
    docs = documents([(1, f"{clean} {item} {clean}"), (2, clean), (3, item), (4, None)], **CLASH)
    got = {r["doc_id"]: r for r in decontaminate.remove_leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert set(got) == {1, 2, 4} and got[1]["text"] == f"{clean}  {clean}" and got[1]["n_chars"] == len(got[1]["text"])
    assert got[2]["text"] == clean and got[2]["row"] == 2


@pytest.mark.parametrize("parts", [1, 3])
def test_leaks_are_found_and_removed_by_one_worker_a_task(spark, documents, monkeypatch, parts):
    rnd = random.Random(8)
    items = [(k, _sentence(rnd, 40)) for k in range(6)]
    rows = [(1, f"{items[0][1]} x y z {items[5][1]} " + _sentence(rnd, 200, 9000)), (2, _sentence(rnd, 30, 9000)), (3, items[2][1]), (4, None), (5, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {r["doc_id"]: r["text"] for r in decontaminate.remove_leaks(documents(rows), bench).collect()}
    assert set(want) == {1, 2, 4, 5} and want[1].startswith(" x y z  ") and want[4] is None
    if parts > 1:
        monkeypatch.setattr(decontaminate, "PART_BYTES", 800)
    out = decontaminate.remove_leaks(documents(rows), bench)
    assert {r["doc_id"]: r["text"] for r in out.collect()} == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_registered_copies_queries_on_small_table(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    want = _brute_spans(rows, 100)
    from millwatch.llm.queries import QUERIES

    for r in QUERIES["op5_suffix_dedup"](spark, sf).collect():
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]]
