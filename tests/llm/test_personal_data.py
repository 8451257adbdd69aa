from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import time

import pytest

from pricefold.llm import personal_data
from pricefold.llm.personal_data import KINDS, SECRET, Model, added_spans, alike, base_spans, beliefs, luhn, secrets, trained

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    """The patterns as they are stated, without regard to time."""
    digits = lambda found: re.sub("[^0-9]", "", found)
    return [
        [found.span() for found in EMAIL.finditer(text)],
        [found.span() for found in IP.finditer(text) if all(int(part) <= 255 for part in found[0].split("."))],
        [found.span() for found in CARD.finditer(text) if 13 <= len(digits(found[0])) <= 19 and luhn(digits(found[0]))],
        [found.span() for found in PHONE.finditer(text) if 9 <= len(digits(found[0])) <= 15],
    ]


def shown(spans):
    return ",".join(f"{kind}:{start}:{end}" for kind, found in zip(KINDS, spans) for start, end in found)


def test_base_spans_equal_the_plain_patterns():
    signs = list("ab.@-+ ()0123456789_%xé") + ["4325404893167225", "+1 (918) 555-4124", "a.b@c.de ", "10.0.0.1", "255.", "256."]
    chance = random.Random(5)
    for _ in range(5000):
        text = "".join(chance.choice(signs) for _ in range(chance.randint(0, 30)))
        assert base_spans(text) == plain(text), repr(text)


@pytest.mark.parametrize("text", ["9" * 200_000, "a" * 200_000, "1." * 100_000, "+1 " * 70_000, "a@" * 100_000, "1.2.3." + "9" * 100_000])
def test_long_runs_take_time_in_proportion(text):
    base_spans(text)


def test_beliefs_on_a_tree_are_exact():
    table = [[2.0 if a == b else 0.0 for b in range(5)] for a in range(5)]
    own = [[0.0, 1.0, 0.5, 0.0, -1.0], [0.3, 0.0, 0.0, 0.0, 2.0], [0.0] * 5]
    found = beliefs(own, [(0, 2, table), (1, 2, table)])

    mass = {
        labels: math.exp(sum(own[i][labels[i]] for i in range(3)) + table[labels[0]][labels[2]] + table[labels[1]][labels[2]])
        for labels in itertools.product(range(5), repeat=3)
    }
    for place in range(3):
        for label in range(5):
            wanted = sum(value for labels, value in mass.items() if labels[place] == label) / sum(mass.values())
            assert abs(found[place][label] - wanted) < 1e-6


TEXT = (
    "Call +1 (918) 555-4124 now. Later 918-555-4124 and 918 555 4124, not 555-999-1234. Mail bob.x@mail.example.com or "
    "bob.x@mail soon. 4325404893167225 is no 4325-4048-9316-9999."
)


def test_other_writings_of_a_base_span_are_added(spark, sf_dir):
    from pricefold.llm.queries import table

    model = trained(table(spark, sf_dir, "documents"))
    base = base_spans(TEXT)
    added = [(TEXT[start:end], KINDS[kind]) for kind, start, end in added_spans(TEXT, base, model, 12.0, 0.9)]
    assert added == [("918-555-4124", "phone"), ("918 555 4124", "phone"), ("bob.x@mail", "email")]
    assert added_spans("Only 918-555-4124 here", base_spans("Only 918-555-4124 here"), model, 12.0, 0.9) == []


def test_a_number_that_stands_a_thousand_times(spark, sf_dir):
    from pricefold.llm.queries import table

    text = "+1 (918) 555-4124 " + "or 918-555-4124 " * 1000
    added = added_spans(text, base_spans(text), trained(table(spark, sf_dir, "documents")), 12.0, 0.9)
    assert len(added) == 1000


def test_repeats_do_not_outvote_a_base_span():
    """However the looks speak against it, what repeats a base span gets its label."""
    looks = [-3.9, -0.1, -3.9, -3.9, -3.9, -1.0]
    model = personal_data.Model({"digits 10": looks, "signs -": looks})
    text = "+1 (918) 555-4124 and " + "918-555-4124, " * 30
    added = added_spans(text, base_spans(text), model, 12.0, 0.9)
    assert len(added) == 30 and {kind for kind, _, _ in added} == {3}


def test_documents_of_all_kinds(spark, odd_documents, no_documents):
    from pyspark.sql import functions as F

    rows = personal_data.personal_data(odd_documents.withColumn("spans", F.lit(1))).collect()
    wanted = sorted(((row.doc_id, shown(plain(row.text or ""))) for row in odd_documents.collect()), key=repr)
    assert sorted(((row.id, row.base_spans) for row in rows), key=repr) == wanted
    assert personal_data.personal_data(no_documents).collect() == []


def test_query_equals_the_plain_patterns(spark, sf_dir):
    from pricefold.llm.queries import op8_personal_data, table

    texts = {row.doc_id: row.text or "" for row in table(spark, sf_dir, "documents").collect()}
    rows = op8_personal_data(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        base = plain(texts[row.doc_id])
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == list(map(len, base))
        assert row.base_sha256 == hashlib.sha256(shown(base).encode()).hexdigest()
        assert set(filter(None, shown(base).split(","))) <= set(row.spans.split(","))


def chances(own, edges):
    """Marginals by all labellings."""
    labels = range(len(own[0]))
    mass = {}
    for chosen in itertools.product(labels, repeat=len(own)):
        total = sum(own[place][label] for place, label in enumerate(chosen))
        mass[chosen] = math.exp(total + sum(table[chosen[a]][chosen[b]] for a, b, table in edges))
    whole = sum(mass.values())
    return [[sum(v for chosen, v in mass.items() if chosen[place] == label) / whole for label in labels] for place in range(len(own))]


def test_beliefs_on_small_graphs_with_circles():
    """Loopy messages are not exact; with ties of middling strength they are near, and the likeliest label is right."""
    chance = random.Random(3)
    for _ in range(30):
        own = [[chance.uniform(-1, 1) for _ in range(3)] for _ in range(5)]
        table = [[0.6 if a == b else 0.0 for b in range(3)] for a in range(3)]
        skew = [[chance.uniform(-0.4, 0.4) for _ in range(3)] for _ in range(3)]
        edges = [(a, b, chance.choice([table, skew])) for a, b in itertools.combinations(range(5), 2) if chance.random() < 0.6]
        for found, wanted in zip(beliefs(own, edges), chances(own, edges)):
            assert all(abs(x - y) < 0.06 for x, y in zip(found, wanted))
            if sorted(wanted)[-1] - sorted(wanted)[-2] > 0.12:
                assert found.index(max(found)) == wanted.index(max(wanted))


def test_a_label_is_heard_at_the_end_of_a_long_chain():
    """A chain is a tree, so its beliefs are exact however long it is: here those of a chain summed from both its ends."""
    n, tie = 300, [[8.0 if a == b else 0.0 for b in range(3)] for a in range(3)]
    own = [[0.0, -math.inf, -math.inf]] + [[0.0, 0.0, 0.01]] * (n - 1)
    step = [[math.exp(value) for value in row] for row in tie]
    ahead, behind = [[1.0, 0.0, 0.0]], [[1.0] * 3]
    for place in range(1, n):
        made = [sum(x * row[label] for x, row in zip(ahead[-1], step)) * math.exp(own[place][label]) for label in range(3)]
        ahead.append([value / sum(made) for value in made])
        made = [sum(row[label] * math.exp(own[-place][label]) * x for label, x in enumerate(behind[-1])) for row in step]
        behind.append([value / sum(made) for value in made])
    wanted = [[x * y for x, y in zip(*pair)] for pair in zip(ahead, reversed(behind))]
    found = beliefs(own, [(place, place + 1, tie) for place in range(n - 1)])
    for mine, exact in zip(found, wanted):
        assert all(abs(x - y / sum(exact)) < 1e-3 for x, y in zip(mine, exact))
    assert found[20][0] > 0.8


def test_strong_ties_in_circles_come_to_rest():
    repel = [[-9.0 if a == b else 0.0 for b in range(2)] for a in range(2)]
    ring = [(place, (place + 1) % 5, repel) for place in range(5)]
    found = beliefs([[0.3, 0.0]] + [[0.0, 0.0]] * 4, ring)
    assert all(abs(sum(row) - 1) < 1e-9 for row in found)


def test_what_resembles_a_base_span_is_added():
    plain_model = Model()
    cases = [
        ("Card 4325404893167225, read as 4325404893167226 by phone.", "4325404893167226", "card"),
        ("Card 4325404893167225, short 432540489316725.", "432540489316725", "card"),
        ("From bob.xy@mail.example.com or bob.xy at mail dot example dot com.", "bob.xy at mail dot example dot com", "email"),
        ("From bob.xy@mail.example.com or bob.xv [at] mail.example.com.", "bob.xv [at] mail.example.com", "email"),
        ("Dial +44 918 555 4124 or 0918 555 4124 today", "0918 555 4124", "phone"),
    ]
    for text, shown_as, kind in cases:
        added = [(text[start:end], KINDS[label]) for label, start, end in added_spans(text, base_spans(text), plain_model, 12.0, 0.9)]
        assert added == [(shown_as, kind)], text
    assert added_spans("Look at example.com, 918-555-4124", [[], [], [], []], plain_model, 12.0, 0.9) == []


def test_a_label_passes_through_what_resembles_what_resembles():
    """The last number shares nothing with the base span; the one between them does with both."""
    text = "Call +1 918 555 4124. Or 918 555 4125. Or 918 555 4135."
    assert not set(alike("19185554124")) & set(alike("9185554135"))
    added = added_spans(text, base_spans(text), Model(), 12.0, 0.9)
    assert [text[start:end] for _, start, end in added] == []
    text = "Call +1 918 555 4124. Or 918 555 4124. Or 918 555 4134. Or 918 555 4139."
    added = added_spans(text, base_spans(text), Model(), 12.0, 0.9)
    assert [text[start:end] for _, start, end in added] == ["918 555 4124", "918 555 4134", "918 555 4139"]


def test_documents_without_a_base_span_go_through_the_field():
    looks = [-9.0, -9.0, -9.0, 0.0, -9.0, -9.0]
    model = Model({"digits 10": looks})
    assert added_spans("Only 918-555-4124 here", [[], [], [], []], model, 12.0, 0.9) == [(3, 5, 17)]


def test_secrets_and_their_repeats():
    text = 'password = "4f9a7c21d0b8" then 4f9a7c21d0b8 alone, not 4f9a7c21d0ff, api-key: abcdefgh, token=x1'
    found = [(text[start:end], kind) for kind, start, end in added_spans(text, base_spans(text), Model(), 12.0, 0.9)]
    assert found == [("4f9a7c21d0b8", SECRET)] * 2
    assert [text[start:end] for start, end in secrets(text)] == ["4f9a7c21d0b8"]


def test_other_writings_of_the_tables_own_spans(spark, sf_dir):
    """To documents with a base span another writing of it is appended, and a decoy of the same shape."""
    from pricefold.llm.queries import table

    docs = table(spark, sf_dir, "documents")
    model, chance = trained(docs), random.Random(7)
    right = wrong = wanted = 0
    for row in docs.where("text is not null").collect():
        base = base_spans(row.text)
        for kind in (0, 2, 3):
            for start, end in base[kind][:1]:
                shown_as = row.text[start:end]
                other = {0: shown_as.replace("@", " [at] "), 2: shown_as[:-1] + "7", 3: shown_as.lstrip("+1 ").replace("(", "")}[kind]
                decoy = re.sub("[0-9]", lambda _: chance.choice("0123456789"), other).replace("[at]", "(at)") if kind else "zq [at] z.org"
                text = f"{row.text} Also {other}, or {decoy}, so."
                again = base_spans(text)
                if [list(spans) for spans in again] != [list(spans) for spans in base]:
                    continue
                wanted += 1
                for label, a, b in added_spans(text, again, model, 12.0, 0.9):
                    if a >= len(row.text):
                        right += label == kind and text[a:b] in other
                        wrong += text[a:b] in decoy and text[a:b] not in other
    assert wanted and right == wanted and wrong == 0


@pytest.mark.parametrize("text", [
    " ".join(str(10**11 + 7919 * n) for n in range(20_000)),
    " ".join(f"u{n}@h" for n in range(20_000)),
    "a" * 200_000 + " at b", "password" * 30_000, "a1" * 100_000, "token=" + "z" * 200_000, " at " * 50_000, "[at]." * 40_000,
])
def test_very_long_texts_with_many_mentions(text):
    began = time.monotonic()
    added_spans(text, base_spans(text), Model(), 12.0, 0.9)
    assert time.monotonic() - began < 30
