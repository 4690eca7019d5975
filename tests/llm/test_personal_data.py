from __future__ import annotations

import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import types as T

from plaudit.llm import personal_data as pd
from plaudit.llm.skip_chain import Graph, Model

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        total = sum(int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def plain(text):
    """The patterns as given, by the standard engine, over code points."""
    found = [(m.start(), k, m.end()) for k, kind in enumerate(PATTERNS)
             for m in re.finditer(PATTERNS[kind], text) if passes(kind, m[0])]
    return sorted(found)


def in_points(text, spans):
    content = text.encode()
    return [(len(content[:s].decode()), k, len(content[:e].decode())) for s, k, e in spans]


def test_base_spans_equal_the_patterns():
    draw = random.Random(1)
    parts = ["a", "b.c", "@", "@@", ".", "-", "+", " ", "  ", "(", ")", "1", "22", "255", "256", "4041894974608795",
             "4041 8949-7460 8795", "+1 (988) 555-2485", "x@y.zz", "1.2.3.4", "é", "日", "\n", "0007", "_%", "555-2485"]
    for _ in range(20000):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(14)))
        assert in_points(text, pd.base_spans(text.encode())) == plain(text), text


@pytest.mark.parametrize("unit", ["a", "1", "1 ", "1.", "a@", "+1", "1-", "+1 (", "@", "a.", "a@b.", "[at]"])
def test_long_texts_take_linear_time(unit):
    began = time.perf_counter()
    pd.base_spans((unit * (400_000 // len(unit))).encode())
    assert time.perf_counter() - began < 8


@pytest.fixture(scope="module")
def made():
    draw = random.Random(7)

    def digits(n):
        return "".join(draw.choice("0123456789") for _ in range(n))

    def card():
        body = digits(15)
        return next(body + d for d in "0123456789" if passes("card", body + d))

    def values():
        return {
            "email": f"{draw.choice('abcdef')}{digits(2)}@m{draw.randrange(9)}.example.org",
            "ip": ".".join(str(draw.randrange(10, 255)) for _ in range(4)), "card": card(),
            "phone": f"+1 ({draw.randrange(200, 999)}) 555-{digits(4)}"}

    words = ["the", "of", "order", "on", "from", "in 1999", "page 12", "version 3.4.5", "room 101", "2024-01-05", "cost 12.50"]

    def text(*given):
        listed = [draw.choice(words) for _ in range(30)]
        for value in given:
            listed.insert(draw.randrange(len(listed)), value + draw.choice(["", ",", "."]) + " and")
        return " ".join(listed).encode()

    train = [text(*draw.sample(list(values().values()), draw.randrange(5))) for _ in range(400)]
    return pd.learn(train), values, text


def test_held_out_forms_are_found_and_clean_texts_left_alone(made):
    model, values, text = made
    caught = total = wrong = 0
    for turn in range(150):
        given = values()
        for k, kind in enumerate(pd.KINDS):
            for form in pd._variants(k, given[kind].encode()):
                content = text(given[kind], form.decode())
                (base, every), = pd.scan([content], model)
                assert set(base) <= set(every)
                total += 1
                added = [content[s:e] for s, label, e in every if label == k and (s, label, e) not in base]
                caught += any(pd.digits_of(a)[-4:] == pd.digits_of(form)[-4:] for a in added)
        (base, every), = pd.scan([text("number 12345678901", "4041894974608796", "300.1.2.3", "55524")], model)
        wrong += len(every) - len(base)
    assert caught >= 0.9 * total and wrong <= 3, (caught, total, wrong)


def test_a_repetition_raises_the_certainty(made):
    model, values, text = made
    phone = values()["phone"]
    bare = pd.digits_of(phone.encode())[-10:].decode()
    alone, = pd.scan([f"call {bare} today".encode()], model)
    together, = pd.scan([f"call {phone} today\n\nor else {bare} today".encode()], model)
    assert not alone[1] and len(together[1]) == 2
    graph = pd.graph_of([pd.tokens_of(f"call {phone} now\n\n or call {bare} now".encode())])
    apart = Model(model.nodes, model.chain, 0 * model.skip)
    assert (graph.hub >= 0).all() and model.marginals(graph)[-1, 4] > apart.marginals(graph)[-1, 4]


def test_messages_are_exact_on_trees_and_near_on_loops():
    rng = np.random.default_rng(2)

    def exact(model, graph):
        many, labels = len(graph.features), model.nodes.shape[1]
        hubs = graph.hub.max(initial=-1) + 1
        total = np.zeros((many, labels))
        for given in itertools.product(range(labels), repeat=many + hubs):
            score = sum(model.nodes[f, given[i]] for i in range(many) for f in graph.features[i])
            score += sum(model.chain[g, given[a], given[b]] for a, b, g in zip(graph.left, graph.right, graph.gap))
            score += sum(model.skip[graph.tie[i], given[i], given[many + graph.hub[i]]] for i in range(many) if graph.hub[i] >= 0)
            for i in range(many):
                total[i, given[i]] += np.exp(score)
        return total / total.sum(axis=1, keepdims=True)

    def model():
        found = Model.blank(5, 3, 2, 2)
        found.nodes[:-1] = rng.normal(size=(5, 3))
        found.chain[:], found.skip[:] = rng.normal(size=(2, 3, 3)), rng.normal(size=(2, 3, 3)) * 0.5
        return found

    features = rng.integers(-1, 5, (5, 3))
    chain = [np.array(v) for v in ([0, 1, 3], [1, 2, 4], [0, 1, 0])]
    tree = Graph(features, *chain, np.array([-1, -1, 0, -1, 0]), np.array([0, 0, 1, 0, 0]))
    loop = Graph(features, *chain, np.array([0, -1, 0, 0, 0]), np.array([0, 0, 1, 0, 0]))
    for _ in range(5):
        m = model()
        assert np.abs(m.marginals(tree, rounds=60) - exact(m, tree)).max() < 1e-6
        assert np.abs(m.marginals(loop, rounds=60) - exact(m, loop)).max() < 0.1


def test_documents_of_a_block_do_not_meet(made):
    model, values, text = made
    texts = [text(*values().values()) for _ in range(20)] + [b"", b"no numbers", b"\n"]
    assert pd.scan(texts, model) == [pd.scan([t], model)[0] for t in texts]


def test_through_spark_with_every_edge_case(spark, made):
    model, values, text = made
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("spans", T.StringType()),
        T.StructField("drawn", T.StringType())])
    rich = "é " + text(*values().values()).decode()
    rows = [(1, rich, "old", "x"), (1, rich, "old", "x"), (2, None, None, None), (None, "", None, None),
            (3, "日本 x@y.zz", "s", None), (4, "1 " * 100_000 + "a@b.cd " + "word " * 100_000, "s", "x")]
    docs = spark.createDataFrame(rows, schema)
    found = pd.find_personal_data(docs)
    assert sorted(found.columns) == ["base_spans", "doc_id", "drawn", "spans", "text"]
    for row in found.collect():
        base = [(s.start, pd.KINDS.index(s.kind), s.end) for s in row.base_spans]
        assert base == plain(row.text or "")
        assert {tuple(s) for s in row.base_spans} <= {tuple(s) for s in row.spans}
    assert pd.find_personal_data(docs.limit(0)).collect() == []
    assert pd.find_personal_data(docs.filter("text = ''")).collect()[0].spans == []
