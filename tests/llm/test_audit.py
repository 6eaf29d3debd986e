"""The filter audit against counting every document at every step."""

from __future__ import annotations

from collections import Counter, defaultdict
from itertools import permutations

import pytest
from conftest import bag
from fixtures import AWKWARD, FOLDER, SCHEMA, WORD, frame, given, imports  # noqa: F401

from clinflow.llm import audit, queries

LABELS = "doc_id long, quality int, toxic int"


def fails(docs):
    least = {}
    for doc_id, text, *_ in docs:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    for doc_id, text, part in docs:
        text = text or ""
        words = WORD.findall(text)
        found = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= x <= "Z" for x in text) > 2 * len(text),
            "D": any(x in text for x in "#$%&*|"),
            "E": doc_id is not None and least[text] < doc_id,
        }
        yield doc_id, part or "", {name for name, failed in found.items() if failed}


def expected(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    counts = defaultdict(lambda: [0] * 6)
    removed = defaultdict(int)
    parts = set()
    rows = list(fails(docs))
    for order in permutations("ABCDE"):
        for doc_id, part, failed in rows:
            parts.add(part)
            gone = False
            for step, name in enumerate(order, 1):
                c = counts[part, "".join(order), step]
                here = name in failed and not gone
                c[2] += name in failed and gone
                gone = gone or name in failed
                c[0] += not gone
                c[1] += here
                c[3] += failed == {name}
                c[4] += here and doc_id in good
                c[5] += here and doc_id in toxic
                removed[part, name] += here
    return Counter((part, order, step, *counts[part, order, step], removed[part, order[step - 1]]) for part, order, step in counts)


def test_awkward_rows(spark):
    labels = [(1, 1, 0), (1, 0, 1), (2, 0, 0), (4, 1, 1), (5, None, 1), (12, 1, None), (13, 1, 1), (None, 1, 1), (99, 1, 1)]
    rows = [*AWKWARD, *[(30 + i, text, "en", "d", 1, *["x"] * 7) for i, text in enumerate(["# a"] * 5 + ["A B c"] * 3)]]
    rows += [(12, "one fish two fish\nsame words here", "en", "other", 1, *["x"] * 7)]
    got = audit.audit(frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    assert Counter(map(tuple, got)) == expected([(r[0], r[1], r[3]) for r in rows], labels)


def test_query(spark):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in given()]
    labels = [(r["doc_id"], r["quality"], r["toxic"]) for r in given(table="labels")]
    assert Counter(map(tuple, queries.op12_audit(spark, FOLDER).collect())) == expected(docs, labels)


def test_no_documents(spark):
    assert audit.audit(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)).collect() == []


def test_no_labels(spark):
    rows = audit.audit(frame(spark), spark.createDataFrame([], LABELS)).collect()
    assert rows and not any(r["good_lost"] or r["toxic_lost"] for r in rows)


@pytest.mark.parametrize("n", [1, 255, 256, 65_535, 65_536, 3_000_000_000])
def test_fields_do_not_run_over(n):
    """A field at its largest, next to fields that are zero and as large."""
    width = max(1, -(-n.bit_length() // 8))
    fields = [1, 0, 1, 1, 0, 0, 1]
    assert audit.unpacked(audit.packed(fields, width) * n, len(fields), width).tolist() == [n * x for x in fields]


def test_many_copies_and_partitions(spark):
    rows = [(i, "the same text" if i % 3 == 0 else f"text {i} # {i % 7}", "en", f"s{i % 2}", 1, *["x"] * 7) for i in range(600)]
    labels = [(i, i % 2, i % 5 == 0 and 1 or 0) for i in range(0, 600, 4)]
    docs, marks = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)
    got = audit.audit(docs, marks)
    assert Counter(map(tuple, got.collect())) == expected([(r[0], r[1], r[3]) for r in rows], labels)
    assert bag(got) == bag(audit.audit(docs.repartition(7), marks))
