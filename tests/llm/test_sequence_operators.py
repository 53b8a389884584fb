"""Conversation trie, fill-in-the-middle and substring dedup against brute force."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from subledger.llm import infill, relz, trie

from test_text_operators import LONG, empty_documents, odd_documents


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------------------ conversation trie


def brute_trie(rows, block=100, most=5):
    """Nodes as (conv_id, depth, parent, n_convs, n_children, n_leaves, saved, ends)."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [x for _, x in sorted(v, key=lambda t: t[0])] for c, v in turns.items()}
    rebuilt = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        rebuilt[c] = tuple(own.get(c - int(np.fmod(c, block)), [])[:h] + seq[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
            if d:
                children[seq[: d - 1]].add(seq[:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in members:
        cost = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += cost
    out = []
    for p, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if rebuilt[c] == p)
        parent = min(members[p[:-1]]) if p else None
        out.append((min(who), len(p), parent, len(who), len(children[p]), leaves[p], saved[p], sha(ends)))
    return sorted(out, key=str)


def spark_trie(frame):
    made = trie.conversation_trie(frame)
    ends = F.lower(F.hex(F.coalesce("ends", F.unhex(F.sha2(F.lit(""), 256)))))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return sorted((tuple(r) for r in made.select(*columns, ends).collect()), key=str)


CONVERSATIONS = "conv_id long, turn long, role string, text string"


def test_trie_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = []
    for c in [*range(0, 60), *range(100, 330, 3), *range(9000, 9040), 12300, -5, -205]:
        for t in range(int(rng.integers(0, 7))):
            # Few texts, so that conversations meet again after their openings.
            rows.append((c, t, str(rng.choice(["user", "assistant"])), "x" * int(rng.integers(0, 3))))
    rows += [(500 + i, t, "user", "the same") for i in range(40) for t in range(3)]  # copies
    rows += [(c, t, "user", f"long {t}" if t < 150 else f"{c} {t}") for c in (700, 712, 733) for t in range(200 + c % 10)]
    rows += [(40, None, "user", "no turn"), (41, 7, None, None), (41, 8, None, "é€"), (None, 0, "user", "lost")]
    frame = spark.createDataFrame(rows, CONVERSATIONS)
    for c in ("x", "path", "owner", "place", "h", "donor", "turns", "ends", "last", "members"):
        frame = frame.withColumn(c, F.lit(1))
    assert spark_trie(frame) == brute_trie(rows)


def test_trie_of_many_copies_in_several_packs(spark):
    frame = spark.range(0, 30_000, 3).select(F.col("id").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("hello").alias("text"))
    rows = [(c, 0, "user", "hello") for c in range(0, 30_000, 3)]
    assert spark_trie(frame) == brute_trie(rows)


def test_trie_edge_cases(spark):
    assert spark_trie(spark.createDataFrame([], CONVERSATIONS)) == []
    assert spark_trie(spark.createDataFrame([(None, 1, "user", "x")], CONVERSATIONS)) == []
    # A conversation whose own turns are all replaced by those of an absent one: the root alone.
    c = next(i for i in range(1, 100) if zlib.crc32(str(i).encode()) % 6 > 2)
    assert spark_trie(spark.createDataFrame([(c, 1, "user", "x")], CONVERSATIONS)) == [(c, 0, None, 1, 0, 1, 0, sha(str(c)))]
    # Repeated rows are repeated turns.
    same = spark.createDataFrame([(200, 1, "user", "x")] * 8, CONVERSATIONS)
    assert [r[1] for r in sorted(spark_trie(same), key=lambda r: r[1])] == list(range(9))


@given(st.integers(0, 10_000), st.integers(1, 10_000))
def test_two_fattest_and_miss_runs(a, n):
    b = a + n
    best = max(range(a + 1, b + 1), key=lambda x: x & -x) if n < 200 else None
    f = trie.two_fattest(a, b)
    assert a < f <= b and (best is None or (f & -f) == (best & -best))
    run = trie.miss_run(a, b)
    assert run[-1] == a + 1 and run == sorted(run, reverse=True) and len(run) <= b.bit_length() + 1
    # A handle on the way of a search is met: that of any edge (a, e] with e below or at b.
    for e in {a + 1, b, (a + b + 1) // 2}:
        assert trie.two_fattest(a, e) in run or trie.two_fattest(a, e) > e


def test_prefix_paths_tell_sequences_apart():
    rng = np.random.default_rng(2)
    a, b = rng.integers(-(2**62), 2**62, (2, 50))
    one = trie.prefix_path(a, b)
    swapped = trie.prefix_path(np.r_[a[1::-1], a[2:]], np.r_[b[1::-1], b[2:]])
    assert len(one) == 50 * trie.WIDTH and one[:16] != swapped[:16] and one[-16:] != swapped[-16:]
    assert trie.prefix_path(a[:20], b[:20]) == one[: 20 * trie.WIDTH]


# ---------------------------------------------------------- fill in the middle

UNIT = re.compile("[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+")


def brute_infill(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digits = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return (doc_id, n, "plain", None, None, text)
    if h[3] % 100 < 80:
        return (doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}")


def test_infill_against_brute_force(spark):
    rng = np.random.default_rng(3)
    parts = ["word", " ", "\n", "é€", " ", "\t", "<", "<P", "P>", ">", "S>", "𝄞", "\x1c", "<M"]
    texts = ["".join(rng.choice(parts, int(rng.integers(0, 60)))) for _ in range(300)]
    more = ["", None, "   ", "a<P>b c d e", "<S>", " lead", "trail ", LONG, "one " * 5000]
    rows = list(enumerate([*texts, *more])) + [(None, "no id at all"), (3, texts[3]), (2**60 + 1, "big id here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("id", "n", "form", "output")})
    made = infill.fill_in_middle(docs)
    key = lambda r: (str(r[0]), r[5])
    assert sorted(map(tuple, made.collect()), key=key) == sorted((brute_infill(i, t) for i, t in rows), key=key)
    for r in made.collect():
        assert infill.restore(r.form, r.output) == (dict(rows)[r.doc_id] or "")
    forms = {r.form for r in made.collect()}
    assert forms == {"plain", "psm", "spm"}
    done = infill.digests(made).select("output_sha256", "restored_sha256").collect()
    assert sorted(map(tuple, done)) == sorted((sha(brute_infill(i, t)[5]), sha(t or "")) for i, t in rows)


def test_infill_odd_rows(spark):
    assert infill.fill_in_middle(odd_documents(spark)).count() == odd_documents(spark).count()
    assert infill.digests(infill.fill_in_middle(empty_documents(spark))).count() == 0


@given(st.lists(st.integers(1, 9), max_size=700))
def test_skip_list_reaches_every_rank(widths):
    lanes = infill.SkipList(np.array(widths, np.int64))
    ends = np.cumsum([0, *widths])
    for rank in {0, 1, len(widths) // 2, len(widths) - 1, len(widths)} - {-1}:
        if rank <= len(widths):
            assert lanes.locate(rank) == ends[rank]
    assert len(lanes.lanes[-1][0]) <= infill.FAN


@settings(max_examples=300)
@given(st.text(alphabet="ab <>PSM\n\té", max_size=40))
def test_units_and_restoration(text):
    assert infill.unit_widths(text).tolist() == [len(u) for u in UNIT.findall(text)]
    for i in range(30):
        _, form, _, _, output = infill.transform(i, text, 100, 50, 1)
        assert infill.restore(form, output) == text


# ------------------------------------------------------------- substring dedup


def brute_repeats(docs, window):
    words = [(i, re.findall("[^\\x20\\x09-\\x0D]+", t or "")) for i, t in docs]
    first = {}
    for i, ws in words:
        for s in range(len(ws) - window + 1) if i is not None else ():
            w = tuple(ws[s : s + window])
            first[w] = min(first.get(w, i), i)
    out = []
    for i, ws in words:
        gone = set()
        for s in range(len(ws) - window + 1) if i is not None else ():
            if first[tuple(ws[s : s + window])] < i:
                gone.update(range(s, s + window))
        out.append((i, len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)))
    return sorted(out, key=str)


def repeats(docs, window):
    return relz.without_repeats(docs, window)


@pytest.mark.parametrize("window", [3, 20, 50])
def test_repeats_against_brute_force(spark, window):
    rng = np.random.default_rng(window)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "x y", "The"]
    make = lambda n: list(rng.choice(vocabulary, n))
    passages = [make(int(n)) for n in rng.integers(window - 2, 3 * window, 6)]
    docs = []
    for i in range(120):
        words = make(int(rng.integers(0, 90)))
        for _ in range(int(rng.integers(0, 3))):
            words[len(words) // 2 : len(words) // 2] = passages[int(rng.integers(0, 6))]
        if i % 5 == 0 and docs:
            words = docs[int(rng.integers(0, len(docs)))][1].split(" ")
            if i % 2 and words:
                words[int(rng.integers(0, len(words)))] = "edited"
        docs.append((int(rng.integers(0, 100)), " ".join(words)))
    long = make(window + 40)
    docs += [(300 + i, " ".join(long[: window + i])) for i in range(30)]
    docs += [(400, " ".join(long * 3)), (401, " ".join(long * 2)), (5, " ".join(long)), (5, " ".join(["but", *long])), (5, " ".join(long))]
    docs += [(None, " ".join(long)), (500, None), (501, ""), (502, " \n "), (503, "\n".join(long)), (-7, " ".join(long[10:]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for c in ("text_id", "place", "windows", "anchor", "print", "ref", "factors", "runs"):
        frame = frame.withColumn(c, F.lit(1))
    found = repeats(frame, window)
    assert sorted((tuple(r) for r in found.select("doc_id", "n_words", "n_removed", "kept").collect()), key=str) == brute_repeats(docs, window)
    # Every factor stands where it says.
    texts = defaultdict(set)
    for i, t in docs:
        texts[i].add(tuple(re.findall("[^\\x20\\x09-\\x0D]+", t or "")))
    for r in found.where("factors is not null").collect():
        for f in r.factors:
            assert f.ref_doc < r.doc_id and f.length >= window
            runs = {w[f.place : f.place + f.length] for w in texts[r.doc_id]}
            assert runs & {w[f.ref_place : f.ref_place + f.length] for w in texts[f.ref_doc]}


def test_a_copy_is_one_factor(spark):
    text = " ".join(f"w{i * i % 97}x{i % 89}" for i in range(400))
    docs = spark.createDataFrame([(1, text), (9, text), (12, "new " + text + " end")], "doc_id long, text string")
    got = {r.doc_id: [(f.place, f.length, f.ref_doc, f.ref_place) for f in r.factors] for r in repeats(docs, 50).where("factors is not null").collect()}
    assert got[9] == [(0, 400, 1, 0)]
    assert sum(f[1] for f in got[12]) >= 400 and min(f[0] for f in got[12]) == 1


def test_repeats_odd_rows(spark):
    got = repeats(odd_documents(spark), 50)
    assert got.count() == odd_documents(spark).count() and got.agg(F.max("n_removed")).first()[0] is not None
    assert repeats(empty_documents(spark), 50).count() == 0


def test_runs_of_windows_become_factors():
    runs = [(0, 3, 1, 7, 5), (3, 2, 1, 7, 8), (5, 1, 2, 7, 0), (9, 1, 1, 7, 14), (10, 1, 1, 8, 15)]
    assert relz.greedy_factors(runs, 50) == [(0, 54, 1, 7, 5), (5, 50, 2, 7, 0), (9, 50, 1, 7, 14), (10, 50, 1, 8, 15)]
