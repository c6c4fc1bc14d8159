"""Small inputs and brute-force versions for the training-data operators."""

import os
import random
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"

#: Letters, marks, digits, spaces and symbols that tokenisers treat apart.
ODD = ("aabcdeTHRES'''rRvlLstmd.,!#éÉΣİß́ 12²١\n\t\x1c\x85 中\U0001f600‍ͅẞﬁ"
       " 　﻿᠎​")

#: Rows every operator must take: null, empty, blank, long, repeated, null id.
EDGE = [(900001, None), (900002, ""), (900003, " \t\n"), (900004, "one two"), (900004, "one two"),
        (None, "a b c a b c"), (900005, "long " * 4000), (900006, "x" * 5000)]


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def documents(spark, limit=None):
    """(doc_id, text) rows of the smallest documents table."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet")
            .select("doc_id", "text").collect()]
    return sorted(rows)[:limit]


def frame(spark, rows, extra=True):
    """Documents with columns whose names clash with the operators' own."""
    schema = "doc_id long, text string"
    if extra:
        schema += ", n_words string, fp long, id string, row int, score double"
        rows = [(*r, "w", 1, "i", 2, 0.5) for r in rows]
    return spark.createDataFrame(rows, schema).repartition(3)


def words(text):
    return [w.decode() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]


def key(row):
    return tuple((v is None, v if v is not None else 0) for v in row)
