"""Spelling variants, decontamination and ranked search against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import EDGE, SF001, documents, frame, key, odd_texts

from logwarden.llm import decontaminate, lexical, ranked_search, spelling_variants

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text):
    return (text or "").translate(str.maketrans(UPPER, LOWER))


def lexical_words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def more_documents():
    return [(700000 + i, t) for i, t in enumerate(odd_texts(120))]


def test_words_and_their_places():
    import pyarrow as pa

    texts = odd_texts(300) + ["", None, "A1b-É9 é", "x" * 3000, "end", "start"]
    at = 0
    for w in lexical.word_groups(pa.array(texts, pa.string())):
        for r, n in enumerate(w.count.tolist()):
            own = range(int(w.first[r]), int(w.first[r]) + n)
            found = [w.text[w.begin[i]:w.end[i]].tobytes().decode() for i in own]
            raw = (texts[at] or "").encode()
            assert found == lexical_words(texts[at])
            assert [lowered(raw[w.start[i]:w.stop[i]].decode()) for i in own] == found
            at += 1
    assert at == len(texts)


# -- spelling variants ------------------------------------------------------------

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def brute_variants(rows, step):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", lowered(text)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if step and h % step == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 6 and c >= 5}
    near = defaultdict(set)
    by_size = defaultdict(list)
    for w in n:
        by_size[len(w)].append(w)
    for w in n:
        for size in (len(w), len(w) + 1):
            for v in by_size[size]:
                if one_edit(w, v):
                    near[w].add(v)
                    near[v].add(w)
    form = {}
    for w in n:
        if near[w]:
            top = min(near[w], key=lambda v: (-n[v], v))
            if n[top] >= 5 * n[w]:
                form[w] = top
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return sorted(out, key=key)


def variant_rows():
    rng = random.Random(4)
    base = ["consider", "façade", "àéîõü", "bookkeeper", "aaaaaaa", "receive", "ÿÿÿÿÿÿÿ"]
    rows = []
    for w in base:                              # each a chain of ever rarer forms
        v = list(w)
        for step in range(4):
            rows += [(800000 + step, " ".join(["".join(v)] * 6 ** (4 - step)))]
            p = rng.randrange(len(v))
            v[p:p + 1] = rng.choice([[], [v[p], "q"], ["é"], ["z"]])
    return rows


@pytest.mark.parametrize("step", [None, 199, 3])
def test_variants_by_brute_force(spark, step):
    rows = documents(spark, 60) + EDGE + variant_rows() + [(900100, "È×÷ÀÀÀ " * 7)]
    got = spelling_variants.spelling_variants(frame(spark, rows), damage_step=step)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = sorted((tuple(r) for r in got.collect()), key=key)
    want = brute_variants(rows, step)
    assert got == want and any(r[1] for r in want) and any(r[2] not in (r[0], r[1]) for r in want)


def test_anagrams_of_one_multiset(spark):
    """Very many words with one letter multiset: all share every signature."""
    rng = random.Random(1)
    words = sorted({"".join(rng.sample("abcdefg", 7)) for _ in range(900)} | {"abcdefgh", "abcdefgi"})
    table = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    got = {(r.a, r.b) for r in spelling_variants.near_pairs(table).collect()}
    assert got == {(a, b) for a in words for b in words if a < b and one_edit(a, b)} and got


def test_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_variants.variant_groups(empty).collect() == []
    assert spelling_variants.variant_groups(frame(spark, [(1, None), (2, "short words")])).collect() == []


# -- decontamination --------------------------------------------------------------

def brute_hits(rows, items, size=10):
    windows = defaultdict(set)
    for i, text in items:
        w = lexical_words(text)
        n = min(size, len(w))
        for at in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[at:at + n])].add("" if i is None else str(i))
    lengths = {len(w) for w in windows}
    out = []
    for i, text in rows:
        w = lexical_words(text)
        hit, found = set(), set()
        for n in lengths:
            for at in range(len(w) - n + 1):
                who = windows.get(tuple(w[at:at + n]))
                if who:
                    found |= who
                    hit |= set(range(at, at + n))
        names = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), names, bool(hit)))
    return sorted(out, key=key)


def benchmark_rows(spark):
    rows = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    return rows + [(1000, "Two words"), (1001, None), (1002, "!!"), (1003, "zz" * 50), (None, "null item text"),
                   (3, rows[9][1]), (10, rows[10][1]), (10, rows[10][1]), (1004, "x" * 5000)]


def contaminated_rows(items):
    rng = random.Random(2)
    rows, texts = [], [t for _, t in items if t and len(t.split()) > 12]
    for i in range(30):
        t = rng.choice(texts).split()
        a = rng.randrange(len(t) - 10)
        cut = t[a:a + rng.choice([9, 10, 11, 30])]
        rows.append((600000 + i, "before. " + rng.choice([" ", "--", "\n"]).join(cut).swapcase() + "; after é"))
    t = texts[0].split()
    return rows + [(600100, " ".join(t[:14])), (600100, " ".join(t[:14])), (None, " ".join(t[:14])),
                   (600101, "two, WORDS two words"), (600102, " ".join(t[:10]) + "é"),
                   (600103, "common " * 3000 + " ".join(t)), (600104, "null item text")]


@pytest.fixture(scope="module")
def tested(spark):
    items = benchmark_rows(spark)
    rows = documents(spark, 120) + EDGE + more_documents() + contaminated_rows(items)
    table = spark.createDataFrame([(*r, "x", 1) for r in items], "item_id long, text string, spans string, n long")
    return rows, items, table


@pytest.mark.parametrize("block", [1_000_000, 150])
def test_hits_by_brute_force(spark, tested, block):
    rows, items, table = tested
    got = decontaminate.contamination(frame(spark, rows), table, block=block)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = brute_hits(rows, items)
    assert sorted((tuple(r) for r in got.collect()), key=key) == want
    assert sum(r[5] for r in want) > 25 and sum(not r[5] for r in want) > 200


@pytest.mark.parametrize("block", [1_000_000, 150])
def test_removal(spark, tested, block):
    rows, items, table = tested
    docs = frame(spark, rows).withColumnRenamed("id", "spans")
    hits = brute_hits(rows, items)
    clean = decontaminate.clean_documents(docs, table, block=block)
    assert clean.columns == docs.columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter(r[0] for r in hits if not r[5])
    cut = decontaminate.without_spans(docs, table, block=block)
    assert cut.columns == docs.columns
    got = defaultdict(list)
    for r in cut.collect():
        got[r.doc_id].append(len(lexical_words(r.text)))
    want = defaultdict(list)
    for i, n, hit, *_ in hits:
        want[i].append(n - hit)
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(v) for i, v in want.items()}
    after = {r.text for r in cut.filter("doc_id = 600101").collect()}
    assert after == {""}


def test_nothing_to_test_against(spark):
    docs, none = frame(spark, [(1, "a b c"), (2, None)]), spark.createDataFrame([], "item_id long, text string")
    got = sorted(tuple(r)[:4] + (r.contaminated,) for r in decontaminate.contamination(docs, none).collect())
    assert got == [(1, 3, 0, 0, False), (2, 0, 0, 0, False)]
    assert decontaminate.contamination(none.withColumnRenamed("item_id", "doc_id"),
                                       none.unionByName(none)).collect() == []


# -- ranked search ----------------------------------------------------------------

def brute_search(rows, items, k=10):
    docs = [(i, Counter(lexical_words(t))) for i, t in rows]
    n_docs = sum(bool(c) for _, c in docs)
    total = sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for i, text in {(i, t or "") for i, t in items}:
        scored = []
        for d, c in docs:
            if c:
                m = 25 + (75 * sum(c.values()) * n_docs) // total
                s = 0
                for t in lexical_words(text):
                    if t in c:
                        w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        s += w * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                if s > 0:
                    scored.append((-s, d is None, d or 0))
        for rank, (s, null, d) in enumerate(sorted(scored)[:k], 1):
            out.append((i, rank, None if null else d, -s))
    return sorted(out, key=key)


@pytest.mark.parametrize("block,step", [(1_000_000, 16), (300, 1)])
def test_search_by_brute_force(spark, tested, monkeypatch, block, step):
    monkeypatch.setattr(ranked_search, "FIRST_STEP", step)
    rows, items, table = tested
    rows = rows + [(500000 + i, rows[5][1]) for i in range(25)] + [(500000, rows[5][1])]     # equal scores
    got = ranked_search.search(frame(spark, rows), table, block=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=key) == brute_search(rows, items)


def test_search_stops_early():
    """With few long lists the best positions end the search before all is met."""
    rng = np.random.default_rng(0)
    n, terms = 20000, 3
    size = np.full(n, terms)
    term = np.tile(np.arange(terms), n)
    impact = np.repeat(rng.integers(1, 1000, n), terms) * 1000 + rng.integers(0, 1000, n * terms)
    lists = ranked_search.ImpactLists(term, impact, size, terms)
    best, met = ranked_search.Best(10), []
    best.add_, best.add = best.add, lambda s, d: (met.append(len(d)), best.add_(s, d))
    factor = np.array([5, 1, 2])
    lists.search(np.arange(terms), factor, np.zeros(terms, np.int64), best.batch(np.arange(n), np.zeros(n, bool)))
    score = (impact.reshape(n, terms) * factor).sum(axis=1)
    want = np.lexsort((np.arange(n), -score))[:10]
    assert (best.id == want).all() and (best.score == score[want]).all()
    assert sum(met) < n / 10 and not lists.seen.any() and not lists.met.any()


def test_search_over_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b"), (2, None)], "item_id long, text string")
    assert ranked_search.search(none, items).collect() == []
    assert ranked_search.search(frame(spark, [(1, None), (2, "--")]), items).collect() == []
    assert ranked_search.search(frame(spark, [(1, "a b")]), items.limit(0)).collect() == []
