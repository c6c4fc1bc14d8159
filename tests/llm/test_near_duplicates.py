"""SimHash, paragraph and byte-string duplicates against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from helpers import EDGE, documents, frame, words

from logwarden.llm import paragraphs, simhash, suffix_dedup
from logwarden.llm.components import components
from logwarden.session import child_names, shared_dir


def fingerprint(text):
    w = words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] * bool(w)
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def union(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def near_copies(base, n, seed, start):
    rng, out = random.Random(seed), []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = rng.choice(base)
        out.append((start + i, " ".join(w)))
    return out


@pytest.fixture(scope="module")
def corpus(spark):
    rows = documents(spark)
    return rows + EDGE + near_copies(rows[7][1].split(), 400, 5, 20000)


def test_components_by_brute_force(spark, corpus, monkeypatch):
    marks = np.array([fingerprint(t) for _, t in corpus], np.uint64)
    pairs = [(i, i + 1 + int(j)) for i in range(len(corpus))
             for j in np.flatnonzero(np.bitwise_count(marks[i + 1:] ^ marks[i]) <= 3)]
    root = union(len(corpus), pairs)
    low = {}
    for i, r in enumerate(root):
        if corpus[i][0] is not None:
            low[r] = min(low.get(r, corpus[i][0]), corpus[i][0])
    want = sorted(((corpus[i][0], f"{int(marks[i]):016x}", low.get(root[i])) for i in range(len(corpus))),
                  key=str)
    docs = frame(spark, corpus)
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(root))


def test_links_across_nodes_and_stretches(spark, monkeypatch):
    """Fingerprints around few centres, more of them than a node holds."""
    rng = random.Random(1)
    centres = [rng.getrandbits(64) for _ in range(3)]
    marks = sorted({c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
                    for c in centres for _ in range(700)})
    v = np.array(marks, np.uint64)
    pairs = [(i, i + 1 + int(j)) for i in range(len(v))
             for j in np.flatnonzero(np.bitwise_count(v[i + 1:] ^ v[i]) <= 3)]
    want = union(len(v), pairs)
    monkeypatch.setattr(simhash, "STRETCH", 100)
    fps = spark.createDataFrame([(int(x) - (1 << 64) if x >> 63 else int(x),) for x in marks], "fp long")
    got = {r.node: r.component for r in components(simhash.fingerprint_links(fps), "a", "b").collect()}
    signed = [int(x) - (1 << 64) if x >> 63 else int(x) for x in marks]
    groups = {}
    for i, s in enumerate(signed):
        groups.setdefault(got.get(s, s), set()).add(want[i])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want))


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r.node: r.component for r in components(edges, "a", "b").collect()}
    assert all(got[i] == 0 for i in range(1, 61)) and got[101] == 100


# -- repeated byte strings ------------------------------------------------------

def random_text(rng, n, letters="abcdef é"):
    return "".join(rng.choice(letters) for _ in range(n))


@pytest.fixture(scope="module")
def byte_rows(spark):
    rng = random.Random(2)
    p, q = random_text(rng, 300), random_text(rng, 150)
    rows = [(1002, "a" * 500), (1003, "a" * 99), (1004, "ab" * 300),
            (1005, random_text(rng, 50) + p + random_text(rng, 50)),
            (1006, random_text(rng, 70) + p[20:] + random_text(rng, 80) + p[:150]),
            (1006, random_text(rng, 70) + p[20:250]), (None, p), (None, p),
            (900, random_text(rng, 10) + p), (1007, q * 3)]
    rows += [(2000 + i, random_text(rng, rng.randint(0, 120)) + q[rng.randint(0, 30):]
              + random_text(rng, rng.randint(0, 120))) for i in range(60)]
    return documents(spark, 120) + EDGE + rows


def without_repeats(rows):
    first, out = {}, []
    data = [(suffix_dedup.LAST_ID if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for k in range(len(b) - 99):
            first[b[k:k + 100]] = min(first.get(b[k:k + 100], (i, k)), (i, k))
    for (i0, _), (i, b) in zip(rows, data):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 99):
            if first[b[k:k + 100]] < (i, k):
                gone[k:k + 100] = True
        spans = int((np.diff(np.r_[False, gone].astype(int)) > 0).sum())
        left = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i0, len(b), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("crowd,collection", [(4096, 1 << 16), (3, 1 << 16), (4096, 8)])
def test_repeated_strings_by_brute_force(spark, byte_rows, monkeypatch, crowd, collection):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "COLLECTION", collection)
    got = suffix_dedup.remove_repeats(frame(spark, byte_rows)).collect()
    assert sorted(map(tuple, got), key=str) == without_repeats(byte_rows)


def test_common_prefixes_of_a_collection():
    """Order and common prefixes after the last column equal a plain sort."""
    rng = np.random.default_rng(0)
    strings = rng.integers(97, 99, (40, suffix_dedup._WIDTH)).astype(np.uint8)
    strings[20:] = strings[:20]
    strings[25, :suffix_dedup.REACH - 10] = 120
    near, far = np.zeros(40, np.int64), np.full(40, suffix_dedup.REACH)
    low, high = suffix_dedup.collection_classes(strings, near, far, np.arange(40))
    assert (high[:20] == -1).all() and (high[20:25] == suffix_dedup.REACH).all()
    assert (low[20:] == 0).all() and high[25] == 10


def test_long_rows_are_taken_in_stretches(spark, monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(suffix_dedup, "STRETCH", 1 << 12)
    t = random_text(rng, 9000)
    rows = [(1, t), (2, random_text(rng, 500) + t[3000:8000]), (3, "é" * 3000)]
    import pyarrow as pa
    finder = suffix_dedup.Anchors()
    f = finder.column(pa.array([x for _, x in rows]))
    covered = {(r, p - d) for r, p, a, b in zip(f["row"].tolist(), f["pos"].tolist(),
                                               f["near"].tolist(), f["far"].tolist())
               for d in range(a, b + 1)}
    want = {(r, s) for r, (_, x) in enumerate(rows) for s in range(len(x.encode()) - 99)}
    assert covered == want


# -- repeated paragraphs ----------------------------------------------------------

@pytest.fixture(scope="module")
def passages():
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(3000)]

    def some(n):
        return [rng.choice(vocab) for _ in range(n)]
    p, q, rows = some(55), some(80), []
    for i in range(300):
        w = some(rng.randint(5, 200))
        if i % 4 == 0:
            k = rng.randint(0, len(w))
            w[k:k] = p
        if i % 7 == 0:
            k = rng.randint(0, len(w))
            w[k:k] = q[:70] + some(3)
        rows.append((i, " ".join(w)))
    return rows + EDGE[:5] + [(None, " ".join(p)), (1002, " ".join(p).upper())]


@pytest.mark.parametrize("block", [256, 3])
def test_planted_passages_are_cut_and_clean_documents_left(spark, passages, monkeypatch, block):
    monkeypatch.setattr(paragraphs, "BLOCK", block)
    docs = frame(spark, passages)
    found = paragraphs.removed_paragraphs(docs).collect()
    hit = {r.doc_id for r in found}
    planted = {i for i in range(300) if i % 4 == 0 or i % 7 == 0}
    assert planted - hit <= {0, 4, 7} and 1002 in hit and None in hit
    assert not [i for i in hit if i is not None and i < 300 and i not in planted]
    assert all(r.source_doc_id is not None and r.stop > r.first for r in found)
    cut = paragraphs.cut_documents(docs)
    assert cut.columns == docs.columns
    text, before = {r.doc_id: r.text for r in cut.collect()}, dict(passages)
    for i in range(300):
        if i not in hit:
            assert text[i] == before[i]
        else:
            assert len(text[i].split()) <= len(before[i].split()) - paragraphs.SPAN
    assert 900002 in text and 900001 in text and text[900001] is None


def test_similarity_is_exact():
    a = np.arange(28, dtype=np.uint64)
    b, c = a.copy(), a.copy()
    b[:3] += np.uint64(100)             # 25 of 31 alike: 0.81
    c[:4] += np.uint64(200)             # 24 of 32 alike: 0.75
    assert paragraphs.similar_pairs([a, b, c]).tolist() == [[0, 1]]
    assert paragraphs.similar_pairs([a, c, b], 1).tolist() == [[0, 2]]


def test_similarity_of_two_sets():
    """Blocks of two go another way than larger ones: same pairs at the limit."""
    far = np.arange(1000, 1028, dtype=np.uint64)
    for n in range(1, 60):
        for same in range(n + 1):
            a, b = np.arange(28, dtype=np.uint64), np.arange(n, dtype=np.uint64)
            b[same:] += np.uint64(500)
            want = paragraphs.similar_pairs([a, b, far]).tolist()
            assert paragraphs.similar_pairs([a, b]).tolist() == want
            assert paragraphs.similar_pairs([a, b], 1).tolist() == want


def test_texts_are_split_once_for_paragraphs_and_once_for_places(spark, passages, tmp_path):
    """The texts are run through for paragraphs, units, repeated rows and places
    (those of repeated rows apart): five times at most."""
    seen, docs = tmp_path / "seen", frame(spark, passages)

    def note(batches):
        for batch in batches:
            with open(seen, "a") as f:
                f.write("x" * batch.num_rows)
            yield batch
    got = paragraphs.removed_paragraphs(docs.mapInArrow(note, docs.schema)).collect()
    assert len(got) > 100 and len(seen.read_text()) <= 5 * len(passages)


@pytest.mark.parametrize("long", [1, 4000])
def test_places_in_texts(long):
    """Shingles, where they stand, and the words around, by plain computation;
    of words with which a unit is shorter and longer than 64 KiB."""
    import re

    import pyarrow as pa
    rng = random.Random(41)
    texts = [" ".join(rng.choice("abcdefg") * long for _ in range(n)) for n in (40, 90, 33)]
    finder = paragraphs.Finder()
    data, offsets = paragraphs.column_bytes(pa.array(texts))
    words = [[m.span() for m in re.finditer(r"\S+", t)] for t in texts]
    spans = [(0, 2, 38), (1, 0, 90), (1, 50, 88), (2, 1, 31)]
    ask = [np.array(x) for x in zip(*((r, words[r][x][0], words[r][y - 1][1]) for r, x, y in spans))]
    sets = finder.spots(data, offsets, ask[0], np.full(4, paragraphs.SET), *ask[1:])
    for (r, x, y), hashes, places in zip(spans, sets["hashes"], sets["places"]):
        own = texts[r].split()
        at = {}
        for k in range(x, y - 4):
            at.setdefault(tuple(own[k:k + 5]), []).append(k)
        kind = np.uint16 if words[r][y - 1][1] - words[r][x][0] < 1 << 16 else np.uint32
        zero = words[r][x][0]
        want = sorted((words[r][k[0]][0] - zero, words[r][k[-1] + 4][1] - zero) for k in at.values())
        assert sorted(zip(*np.frombuffer(places, kind).reshape(2, -1).tolist())) == want
        assert len(set(np.frombuffer(hashes, np.uint64).tolist())) == len(at) == len(hashes) // 8
    ends = finder.spots(data, offsets, ask[0], np.full(4, paragraphs.END), *ask[1:])
    for (r, x, _), around, reach in zip(spans, ends["around"], ends["reach"]):
        n, far = len(words[r]), np.frombuffer(reach, np.int32).reshape(2, -1).tolist()
        assert far[0] == [words[r][max(0, x - k)][0] for k in range(paragraphs.WINDOW)]
        assert far[1] == [words[r][min(n, x + paragraphs.SPAN + k) - 1][1] for k in range(paragraphs.WINDOW)]
        left, right = (np.frombuffer(around, np.uint32).reshape(2, -1) > 0).sum(axis=1)
        assert left == min(x, paragraphs.WINDOW - 1) and right == min(n - x - paragraphs.SPAN, paragraphs.WINDOW - 1)


def test_edited_passage_ends_are_linked(spark):
    """Paragraphs that differ in their last word only: similar, not equal."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(3000)}" for _ in range(paragraphs.SPAN - 1)]
    rows = [(i, " ".join(base + [f"end{i}"])) for i in range(5)]
    found = paragraphs.removed_paragraphs(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.source_doc_id) for r in found) == [(i, 0) for i in range(1, 5)]


def test_empty_tables(spark):
    docs = frame(spark, [(1, "x")]).limit(0)
    for op in (simhash.near_duplicates, simhash.keep_one, suffix_dedup.remove_repeats,
               paragraphs.removed_paragraphs, paragraphs.cut_documents):
        assert op(docs).collect() == []


def test_removal_holds_only_the_ranges_on_disk(spark, byte_rows):
    """What led to the ranges is deleted before the texts are joined to them."""
    base = f"{shared_dir(spark)}/logwarden"
    before = set(child_names(spark, base))
    out = suffix_dedup.remove_repeats(frame(spark, byte_rows))
    made = {n.rsplit("-", 1)[0] for n in set(child_names(spark, base)) - before}
    assert made == {"llm-key-counts", "llm-repeated-ranges"}
    assert sorted(map(tuple, out.collect()), key=str) == without_repeats(byte_rows)


def test_rows_without_ids_stay_apart(spark):
    """Thousands of different texts with one (null) id: each loses its own ranges."""
    rng = random.Random(12)
    p = random_text(rng, 140, "abcdefgh ")
    rows = [(None, random_text(rng, rng.randint(0, 90)) + (p if i % 2 else "")) for i in range(3000)]
    rows += [(5, p), (6, random_text(rng, 30) + p)]
    got = suffix_dedup.remove_repeats(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == without_repeats(rows)


def test_paragraphs_of_rows_without_ids(spark):
    rng = random.Random(13)

    def some(n):
        return [f"w{rng.randrange(3000)}é" for _ in range(n)]
    p = some(60)
    rows = [(None, " ".join(some(rng.randint(0, 30)) + (p if i % 2 else some(3)))) for i in range(3000)]
    rows.append((5, " ".join(p)))
    got = [r.text for r in paragraphs.cut_documents(frame(spark, rows)).collect()]
    clean = {t for i, t in rows if i == 5 or " ".join(p) not in t}
    assert clean <= set(got)
    # the others keep nothing of the passage but a window at each end
    left = [t for t in got if t not in clean]
    assert all(len(set(t.split()) & set(p)) <= 2 * paragraphs.WINDOW for t in left)


def test_near_copies_with_interior_edits(spark):
    """All pairs of lines of similarity 0.8 by brute force, whatever words differ."""
    rng = random.Random(21)

    def some(n):
        return [f"w{rng.randrange(5000)}" for _ in range(n)]
    lines = []
    for _ in range(60):
        base = some(rng.randint(40, 120))
        lines.append(base)
        for _ in range(4):
            w = list(base)
            for _ in range(rng.randint(1, 2)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
            lines.append(w)
    rng.shuffle(lines)
    rows = [(i, " ".join(some(5)) + "\n" + " ".join(w) + "\n" + " ".join(some(6))) for i, w in enumerate(lines)]
    sets = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in lines]
    pairs = [(i, j) for j in range(len(sets)) for i in range(j)
             if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    root = union(len(lines), pairs)
    want = {i for i, r in enumerate(root) if i != r}
    cut = {r.doc_id: r.text for r in paragraphs.cut_documents(frame(spark, rows)).collect()}
    # edited words at a line's ends, which the kept line does not hold, stay
    gone = {i for i, w in enumerate(lines) if len(set(w) & set(cut[i].split())) <= 20}
    assert len(pairs) > 100 and len(want & gone) >= 0.99 * len(want)
    # a document with no like keeps all
    alone = {i for i in range(len(lines)) if not any(sets[i] & sets[j] for j in range(len(sets)) if j != i)}
    assert all(cut[i] == rows[i][1] for i in alone)


def test_units_come_back_after_an_edit():
    """Pieces of a text without line breaks cover it, and return after an edit."""
    import pyarrow as pa
    rng = random.Random(22)
    w = [f"w{rng.randrange(5000)}" for _ in range(3000)]
    v = list(w)
    v[1500] = "edit"
    texts = pa.array([" ".join(w), " ".join(v), " ".join(w[700:]), "a b", "same " * 2000])
    f = paragraphs.Finder().units(texts)
    of = [set(f["content"][f["row"] == r].tolist()) for r in range(5)]
    assert len(of[0] - of[1]) <= 3 and len(of[2] - of[0]) <= 2 and not of[3] and of[4]
    at = f["row"] == 0
    assert (np.sort(f["first"][at])[1:] == np.sort(f["stop"][at])[:-1] + 1).all()


def test_one_row_of_each_component_stays(spark):
    """Rows that share an id, with unlike texts: none is a copy of another."""
    rng = random.Random(31)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(80)) for _ in range(6)]
    rows = [(7, t) for t in texts] + [(3, texts[0]), (7, texts[1]), (None, texts[2])]
    kept = simhash.keep_one(frame(spark, rows)).collect()
    assert sorted(r.text for r in kept) == sorted(texts)
    assert {r.doc_id for r in kept if r.text == texts[0]} == {3}


def test_paragraphs_in_any_row_order(spark):
    """The input gives its rows in another order each time it is evaluated."""
    import pyarrow as pa

    rng = random.Random(41)

    def some(n):
        return [f"w{rng.randrange(3000)}" for _ in range(n)]
    p, rows = some(60), []
    for i in range(160):
        rows.append((i, " ".join(some(rng.randint(0, 40)) + p + some(rng.randint(0, 40)))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)

    def shuffled(batches):
        table = pa.Table.from_batches(list(batches), pa.schema([("doc_id", pa.int64()), ("text", pa.string())]))
        order = np.random.default_rng().permutation(table.num_rows)
        yield from table.take(pa.array(order)).to_batches(max_chunksize=7)

    unstable = docs.mapInArrow(shuffled, docs.schema)
    got, want = (sorted(set(map(tuple, paragraphs.removed_paragraphs(d).collect()))) for d in (unstable, docs))
    assert got == want and {r[0] for r in got} == set(range(1, 160))


def test_repeated_strings_in_any_row_order(spark):
    """The input gives its rows in another order each time it is evaluated: the
    shared passage goes whole from all copies but the earliest."""
    import pyarrow as pa

    rng = random.Random(43)

    def some(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = some(300)
    rows = [(i, some(rng.randint(100, 300)) + passage + some(rng.randint(100, 300))) for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)

    def shuffled(batches):
        table = pa.Table.from_batches(list(batches), pa.schema([("doc_id", pa.int64()), ("text", pa.string())]))
        order = np.random.default_rng().permutation(table.num_rows)
        yield from table.take(pa.array(order)).to_batches(max_chunksize=7)

    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeats(
            docs.mapInArrow(shuffled, docs.schema)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got[0] == 0 and all(300 <= got[i] < 310 for i in range(1, 160))


@pytest.mark.parametrize("size", [47, 60, 100])
def test_repeated_passages_go_whole(spark, size):
    """Passages pasted between unrelated words go to the last word from all
    copies but the earliest; the words beside them stay."""
    rng = random.Random(size)

    def some(n):
        return [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    rows, want = [], {}
    for pair in range(40):
        passage = some(size)
        for k in range(3):
            before, after = some(rng.randint(0, 60)), some(rng.randint(0, 60))
            rows.append((pair * 3 + k, " ".join(before + passage + after)))
            want[pair * 3 + k] = before + passage * (k == 0) + after
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["text"].split() for r in paragraphs.cut_documents(docs).collect()}
    assert got == {i: w for i, w in want.items() if w}
