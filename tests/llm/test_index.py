"""The positional index against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import positional_index, shared

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
VOCABULARY = [f"w{i}" for i in range(30)] + ["the"] * 30 + ["Öl", "naïve", "x2"]


def words(text):
    return WORD.findall((text or "").translate(LOW))


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(11)

    def text(n):
        return "".join(draw.choice(VOCABULARY) + draw.choice([" ", ", ", "\n", "_", "-"]) for _ in range(n))

    items = [(i, text(draw.randrange(8, 25))) for i in range(12)]
    items += [(20, "the"), (21, "the the the the the the the the the the the"), (22, "Unseen words only here"), (23, "W1 w2"), (24, None), (25, " .,"), (None, items[0][1]), (26, items[1][1]), (3, "w5 w6 w7 Öl")]
    docs = [(i, text(draw.randrange(0, 60))) for i in range(60)]
    for i in range(60, 90):
        item = words(draw.choice(items[:12])[1])
        at = draw.randrange(max(1, len(item) - 10))
        docs.append((i, f"{text(draw.randrange(0, 9))} {' '.join(item[at : at + draw.choice([9, 10, 11, 40])]).upper()}. {text(5)}"))
    docs += [(100, None), (101, ""), (None, items[2][1]), (None, None), (102, "the " * 5000), (7, docs[70][1]), (7, docs[70][1]), (103, "w1 w2 w1 w2")]
    return docs, items


def tables(spark, docs, items):
    documents = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in docs], "doc_id long, text string, row int, term int, pos int")
    return documents.repartition(4), spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, phrase int")


def brute(docs, items, window):
    windows = {}
    for item, t in items:
        w = words(t)
        for s in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[s : s + window]), set()).add(item)
    out = []
    for doc, t in docs:
        w, hit, found = words(t), set(), set()
        for size in {len(g) for g in windows}:
            for s in range(len(w) - size + 1):
                own = windows.get(tuple(w[s : s + size]))
                if own:
                    hit |= set(range(s, s + size))
                    found |= own
        names = sorted(str(i) for i in found - {None})
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("window,limit", [(10, 200_000), (1, 200_000), (2, 200_000), (3, 3)])
def test_contamination(spark, rows, monkeypatch, window, limit):
    monkeypatch.setattr(positional_index, "few", lambda keys: shared.few(keys, limit))
    documents, items = tables(spark, *rows)
    got = positional_index.contamination(documents, items, window)
    assert sorted(map(tuple, got.collect()), key=str) == brute(*rows, window)


def test_empty_tables(spark, rows):
    documents, items = tables(spark, *rows)
    assert positional_index.contamination(documents.limit(0), items).count() == 0
    clean = positional_index.contamination(documents, items.limit(0))
    assert clean.count() == len(rows[0]) and clean.where("contaminated OR n_items > 0 OR n_hit > 0").isEmpty()


def test_main_path_has_no_python(spark, rows):
    documents, items = tables(spark, *rows)
    terms = positional_index.vocabulary(items)
    plan = positional_index.index(documents, terms)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("span", [1, 2, 8, 50])
def test_proximity(spark, rows, span):
    docs, _ = rows
    asked = {"a": ["w1", "w2"], "b": ["w3", "the", "Öl"], "c": ["the"], "d": ["w4", "lacking"], "e": ["w1", "w1", "w7"]}
    documents, items = tables(spark, docs, [(1, " ".join(VOCABULARY) + " lacking")])
    terms = positional_index.vocabulary(items)
    postings = positional_index.index(documents, terms)
    wanted = spark.createDataFrame([(q, w) for q, ws in asked.items() for w in ws], "query string, word string").join(terms, "word")
    found = positional_index.near(postings, wanted.select("query", "term"), span)
    ids = postings.where("pos = 0").select("row", F.col("n_words"), "doc_id")
    got = sorted((r["query"], str(r.doc_id), r.n_words, r.start, r.end) for r in found.join(ids, "row").collect())
    expected = []
    for doc, t in docs:
        w = words(t)
        for q, ws in asked.items():
            whole = [(s, e) for s in range(len(w)) for e in range(s, min(len(w), s + span)) if set(ws) <= set(w[s : e + 1])] if len(w) < 1000 or q == "c" else []
            least = set(whole)
            expected += [(q, str(doc), len(w), s + 1, e + 1) for s, e in whole if not any(s <= s2 and e2 <= e and (s, e) != (s2, e2) for s2, e2 in [(s + 1, e), (s, e - 1)] if (s2, e2) in least)]
    assert got == sorted(expected)
