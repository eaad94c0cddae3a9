"""Near-duplicates, fingerprints, personal data, vectors and tool calls against brute force."""

import hashlib
import json
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from beatmetrics.llm import chat_tools, pii
from beatmetrics.llm.components import components, joined
from beatmetrics.llm.embedding_dedup import hadamard, near_vectors
from beatmetrics.llm.fingerprint import edited_likeness
from beatmetrics.llm.jaccard_join import keep_first, near_duplicates


class Groups:
    def __init__(self):
        self.top = {}

    def find(self, x):
        while self.top.setdefault(x, x) != x:
            x = self.top[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.top[max(a, b)] = min(a, b)


def brute_groups(docs, n, percent):
    sets = {}
    for i, text in docs:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", lower)
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    groups = Groups()
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                groups.join(a, b)
    return {i: (len(s), groups.find(i)) for i, s in sets.items()}


@pytest.fixture(scope="module")
def copies():
    """Groups of near copies larger than the limit of rare shingles, and a common passage."""
    chance = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    docs = []
    for length, edits in ((30, 1), (120, 6)):
        base = chance.choices(words, k=length)
        for _ in range(70):
            own = list(base)
            for _ in range(chance.randint(0, edits)):
                own[chance.randrange(length)] = chance.choice(words)
            docs.append(" ".join(own))
    passage = chance.choices(words, k=40)
    for _ in range(80):
        a, b = (chance.choices(words, k=chance.randint(3, 25)) for _ in range(2))
        docs.append(" ".join(a + passage + b))
    docs += ["", "a", "a b", "A B", None, "a b c d", "a b c d", "x"] * 2
    return list(enumerate(docs))


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_jaccard_join_equals_brute_force(spark, copies, n, percent):
    df = spark.createDataFrame([(i, t, i) for i, t in copies], "doc_id long, text string, n long")
    expected = brute_groups(copies, n, percent)
    rows = near_duplicates(df, n_words=n, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    assert len(rows) == len(copies)


def test_jaccard_join_with_small_limits_equals_brute_force(spark, copies, monkeypatch):
    for name, value in (("HEADS", 1), ("CROWD", 2)):
        monkeypatch.setattr(f"beatmetrics.llm.jaccard_join.{name}", value)
    df = spark.createDataFrame(copies, "doc_id long, text string")
    rows = near_duplicates(df).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_groups(copies, 4, 85)


def test_jaccard_join_of_odd_rows(spark):
    schema = "doc_id long, text string, n long"
    assert near_duplicates(spark.createDataFrame([], schema)).collect() == []
    rows = [(5, "a b c d e", 1), (5, "f g h i j", 2), (None, "a b c d e", 3), (3, "f g h i j", 4)]
    df = spark.createDataFrame(rows, schema)
    found = sorted(near_duplicates(df).collect(), key=str)
    assert sorted(str((r.doc_id, r.component_id)) for r in found) == [
        "(3, 3)", "(5, 3)", "(5, 5)", "(None, None)",
    ]
    kept = keep_first(df)
    assert kept.columns == df.columns and {r.n for r in kept.collect()} >= {3, 4}


def test_one_row_of_each_group_stays(spark):
    near = " ".join(f"w{i}" for i in range(60))
    rows = [
        (5, "a b c d e", 1), (5, "f g h i j", 2), (None, "a b c d e", 3), (3, "f g h i j", 4),
        (7, "k l m n o", 5), (7, "k l m n o", 5), (7, "p q r s t", 6),
        (None, "u v w x y", 7), (None, "u v w x y", 7), (None, "z z", 8),
        (9, near, 9), (8, near + " more", 10), (8, "other words that nobody else has", 11),
        (2, None, 12), (2, "", 13), (None, None, 14),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row long").repartition(4)
    kept = keep_first(df)
    assert kept.schema == df.schema
    assert sorted(r._row for r in kept.collect()) == [3, 4, 5, 6, 7, 8, 10, 11, 12, 13, 14]
    assert sorted(r.n for r in keep_first(
        spark.createDataFrame(rows[:4], "doc_id long, text string, n long")
    ).collect()) == [3, 4]
    assert keep_first(df.limit(0)).collect() == []


def test_components_of_a_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {
        **{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)},
    }


def jobs_of(spark, name, action):
    """The action's result and the number of Spark jobs behind it."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        return action(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_links_that_are_stars_take_no_round(spark):
    links = [(1, k) for k in range(2, 9)] + [(20, 10), (30, 10), (10, 30)]
    df = spark.createDataFrame(links, "a long, b long")
    rows, jobs = jobs_of(spark, "stars", lambda: joined(df).collect())
    assert {r.node: r.component for r in rows} == {**{k: 1 for k in range(2, 9)}, 20: 10, 30: 10}
    assert jobs <= 8
    assert {r.node for r in components(df).collect()} == {*range(1, 9), 10, 20, 30}
    for more, least in ([(8, 20)], 1), ([(9, 9)], 1), ([(40, 30), (0, 40)], 0):
        df = spark.createDataFrame(links + more, "a long, b long")
        groups = Groups()
        for a, b in links + more:
            groups.join(a, b)
        found = {r.node: r.component for r in components(df).collect()}
        assert found == {x: groups.find(x) for x in groups.top if x != 9}
        assert min(found.values()) == least


def test_join_skips_steps_without_pairs(spark):
    """Every job takes driver memory, so what has nothing to compare runs none."""
    texts = [" ".join(f"w{i}_{k}" for k in range(30)) for i in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows, jobs = jobs_of(spark, "apart", lambda: near_duplicates(df).collect())
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == [
        (i, 27, i) for i in range(20)
    ]
    assert jobs <= 60
    # Pairs only under a crowded key, links only among few: nothing found in between is needed.
    near = [" ".join(["p"] * 9 + [f"v{i}_{k}" for k in range(30)]) for i in range(5)]
    near += [t + " end" for t in near]
    df = spark.createDataFrame(list(enumerate(near)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_duplicates(df).collect()}
    assert found == {i: i % 5 for i in range(10)}


def test_fingerprints(spark):
    chance = random.Random(9)
    words = [f"w{i}" for i in range(2000)]
    docs = {k * 97: " ".join(chance.choices(words, k=chance.randint(0, 300))) for k in range(30)}
    docs |= {5000: None, 5001: "", 5002: "Äx 😀 y", 5003: docs[97], 9000: "w " * 50_000}
    df = spark.createDataFrame([(i, t, 1) for i, t in docs.items()], "doc_id long, text string, own long")
    found = {r.doc_id: r for r in edited_likeness(df).collect()}
    assert len(found) == len(docs)

    def cut(text):
        w = text.lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    ids = sorted(docs)
    for k, i in enumerate(ids):
        text, behind = docs[i] or "", docs[ids[(k + 1) % len(ids)]] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + behind[:half]
        assert found[i].n_chars == len(text)
        assert found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for near, other in (("near_edited", edited), ("near_next", behind)):
            a, b = cut(text), cut(other)
            share = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(found[i][near] - share) < 0.2
    assert found[97].fingerprint == found[5003].fingerprint
    assert edited_likeness(df.limit(0)).collect() == []
    twice = spark.createDataFrame([(None, "a"), (1, "b c"), (1, "b c")], "doc_id long, text string")
    assert edited_likeness(twice).count() == 3


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    out = []
    only = lambda s: re.sub("[^0-9]", "", s)
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((1, m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((2, m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 16 <= len(only(m[0])) <= 19 and luhn(only(m[0])):
            out.append((3, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(only(m[0])) <= 15:
            out.append((4, m.start(), m.end()))
    return ",".join(f"{pii.KINDS[k - 1]}:{a}:{b}" for k, a, b in sorted(out))


def test_base_spans_equal_python(spark):
    chance = random.Random(5)
    parts = [
        "a", "B", "@", ".", "x-y", "1", "255", "256", "0", "-", " ", "+", "(", ")", "%", "_", "é", "😀",
        "4111111111111111", "", "", "\n", "1.2.3.4", "+1 (988) 555-2485", "foo.4@m.example",
    ]
    texts = ["", None, "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "a" * 50_000, "1 " * 20_000, "a@b" + ".c" * 9000]
    texts += ["".join(chance.choices(parts, k=chance.randint(0, 40))) for _ in range(800)]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, kind int")
    rows = pii.find(df, pii.Trees()).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.spans == base_spans(texts[r.doc_id] or ""), texts[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()
    empty = df.limit(0)
    assert pii.find(empty, pii.fit(empty)).collect() == []


def test_boosted_candidates_recover_joined_numbers(spark):
    chance = random.Random(6)

    def card():
        head = "4" + "".join(chance.choices("0123456789", k=14))
        return next(head + c for c in "0123456789" if luhn(head + c))

    rows = [(k, f"pay {card()} or {chance.randint(10**15, 10**16 - 1)}x now") for k in range(400)]
    rows += [(k, f"at 10.0.0.77 {card()} then") for k in range(400, 410)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(df)
    added = {r.doc_id: r.spans for r in pii.find(df, model).collect()}
    texts = dict(rows)
    assert all(base_spans(texts[k]) in added[k] for k in added)
    assert sum("card:13:29" in added[k] for k in range(400, 410)) >= 9
    clean = {r.doc_id: r.text for r in pii.redact(df, model).collect()}
    assert clean[0].startswith("pay [CARD] or ") and clean[405] == "at [IP] [CARD] then"


def test_hadamard_is_orthogonal():
    matrix = hadamard(np.eye(16))
    assert (matrix @ matrix.T == 16 * np.eye(16)).all()


def test_vectors_equal_brute_force(spark):
    random_ = np.random.default_rng(8)
    centers = random_.normal(size=(6, 32))
    x = np.concatenate([random_.normal(size=(150, 32))] + [
        c + random_.normal(size=(n, 32)) * 0.2 for c, n in zip(centers, (3, 10, 40, 2, 600, 5), strict=True)
    ])
    rows = [(k, [float(v) for v in x[k]]) for k in range(len(x))] + [(5000, [float(v) for v in x[0]])]
    odd = [(5001, None), (5002, [0.0] * 32), (5003, [float("nan")] * 32), (5004, [None] * 32), (None, [1.0] * 32), (5005, [])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in near_vectors(df).collect()}
    whole = np.array([v for _, v in rows])
    whole /= np.linalg.norm(whole, axis=1)[:, None]
    near = whole @ whole.T >= 0.9
    np.fill_diagonal(near, False)
    links = sum(found[i].n_links for i, _ in rows)
    assert 0.99 * near.sum() <= links <= near.sum()
    assert found[5000].component_id == 0 and not found[5000].kept and found[0].kept
    assert all(found[k].n_links == 0 for k in (5001, 5002, 5003, 5004, 5005))
    assert found[None].component_id is None and not found[None].kept
    assert near_vectors(df.limit(0)).collect() == []


SCHEMAS = {"add": {"a": ("integer", True), "b": ("number", False)}, "say": {"text": ("string", True)}}


def test_tool_calls(spark):
    calls = [
        (1, "x", 1, "add", '{ "b": 1.5, "a": 2 }', ["nowhere"]),
        (1, "y", 3, "say", '{"text": "é \\" z", "more": 1}', ["x"]),
        (1, "z", 2, "add", '{"a": "1"}', ["y", "x"]),
        (1, "z", 9, "add", '{"a": 1}', []),
        (2, "p", 1, "say", '{"text": ', ["q"]),
        (2, "q", 2, "say", "[1]", ["p"]),
        (3, "n", 1, "fly", "{}", None),
        (None, "n", 1, "add", "{}", []),
    ]
    results = [(1, "x", 2, "later"), (1, "x", 1, "three"), (9, "o", 1, None), (1, None, 1, "?")]
    found = chat_tools.link(
        spark.createDataFrame(calls, "conv_id long, call_id string, turn long, name string, arguments string, after array<string>"),
        spark.createDataFrame(results, "conv_id long, call_id string, turn long, content string"),
        SCHEMAS,
    ).collect()
    by = {(r.conv_id, r.call_id): r for r in found}
    assert len(found) == 9
    assert (by[1, "x"].status, by[1, "x"].n_results, by[1, "x"].position) == ("ok", 2, 0)
    assert by[1, "x"].json == '{"arguments":{"a":2,"b":1.5},"id":"x","name":"add","result":"three"}'
    assert (by[1, "y"].status, by[1, "y"].level, by[1, "y"].problems) == ("invalid", 1, ["unknown parameter"])
    assert (by[1, "z"].level, by[1, "z"].position, by[1, "z"].n_calls) == (2, 2, 2)
    assert by[1, "z"].problems == ["type of a"]
    assert by[2, "p"].status == by[2, "q"].status == "cycle" and by[2, "p"].level is None
    assert by[3, "n"].problems == ["unknown tool"]
    assert by[9, "o"].status == "orphan"
    assert [r.status for r in found if r.conv_id is None or r.call_id is None] == ["no_id"] * 2


def test_tool_calls_keep_canonical_json(spark):
    from beatmetrics.llm.queries import TOOL_SCHEMAS, tool_calls

    texts = [(c, t, ("user", "assistant")[t % 2], "é" * (c * 7 + t)) for c in range(30) for t in range(8)]
    df = spark.createDataFrame(texts, "conv_id long, turn long, role string, text string")
    calls, results = tool_calls(df)
    found = chat_tools.link(calls, results, TOOL_SCHEMAS).collect()
    assert sum(r.n_calls for r in found) == 120 and sum(r.n_results for r in found) == 120
    places = defaultdict(list)
    for r in found:
        if r.json:
            plain = json.dumps(json.loads(r.json), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
            assert r.json == plain
        if r.position is not None:
            places[r.conv_id].append((r.position, r.turn))
    assert all(sorted(p)[0][0] == 0 and len({x for x, _ in p}) == len(p) for p in places.values())


def test_other_turns_have_rows_of_their_own(spark):
    """All calls, results and other turns of the table are counted in some row."""
    from beatmetrics.llm.queries import TOOL_SCHEMAS, other_turns, tool_calls

    roles = ["system", "user", "assistant", None, "tool", "assistant", "user"]
    rows = [(c, t, r, "text", "own") for c in (1, 2, None) for t, r in enumerate(roles)]
    rows += [(3, None, "system", None, "own"), (3, 1, "", "", "own")]
    df = spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, call_id string"
    )
    found = chat_tools.link(*tool_calls(df), TOOL_SCHEMAS, other_turns(df)).collect()
    others = [r for r in found if r.status == "other"]
    assert sorted(str((r.conv_id, r.turn)) for r in others) == sorted(
        str((c, t)) for c, t, r, *_ in rows if r not in ("user", "assistant")
    )
    assert sum(r.n_calls + r.n_results for r in found) + len(others) == len(rows)
    empty = df.limit(0)
    assert chat_tools.link(*tool_calls(empty), TOOL_SCHEMAS, other_turns(empty)).collect() == []


def personal(n):
    """Texts with one span of each kind, and decoys."""
    chance = random.Random(n)
    digits = lambda k: "".join(chance.choices("0123456789", k=k))
    for i in range(n):
        head = "4" + digits(14)
        card = next(head + c for c in "0123456789" if luhn(head + c))
        yield (
            f"write ann{i}@mail{i}.example or 10.{i}.7.{chance.randint(1, 250)} pay {card} "
            f"call +1 ({digits(3)}) {digits(3)}-{digits(4)} ok {digits(16)}x v{digits(2)}"
        )


def test_redact_keeps_columns_whatever_their_names(spark):
    names = ["_text", "_base", "_candidates", "c0", "text", "_gaps", "_spans"]
    data = [(t, "b", "c", "d", t, None, 7) for t in personal(30)] + [("x", "b", "c", "d", None, 1, 7)]
    df = spark.createDataFrame(data, "_text string, _base string, _candidates string, c0 string, "
                               "text string, _gaps int, _spans int")
    model = pii.fit(df.withColumn("doc_id", df["_spans"].cast("long")))
    clean = pii.redact(df, model)
    assert clean.columns == names and clean.schema == df.schema
    got = sorted(clean.collect(), key=str)
    assert sorted(r["_text"] for r in got) == sorted(d[0] for d in data)
    for r in got:
        assert (r["_base"], r["_candidates"], r.c0, r["_spans"]) == ("b", "c", "d", 7)
        if r.text is None:
            assert r["_text"] == "x"
        else:
            text, out, at = r["_text"], [], 0
            for s in sorted((int(a), int(b), k) for k, a, b in
                            (x.split(":") for x in base_spans(text).split(",") if x)):
                out += [text[at : s[0]], f"[{s[2].upper()}]"]
                at = s[1]
            assert r.text == "".join(out) + text[at:]
