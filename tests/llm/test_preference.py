"""Preference formatting against a plain version; native plans."""

import random

from orderflow.llm.preference import branches, format_preferences
from orderflow.llm.queries import QUERIES

from .helpers import SF

SIDE = "pair_id long, turn int, role string, text string, c string, part string"


def side(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SIDE)


def render(role, text):
    return f"<|im_start|>{role}\n{text}<|im_end|>\n"


def plain(chosen, rejected):
    out = []
    for pair in {r[0] for r in chosen + rejected}:
        sides = [{}, {}]
        for s, rows in zip(sides, (chosen, rejected), strict=True):
            for p, turn, role, text in rows:
                if p == pair and turn is not None:
                    s.setdefault(turn, set()).add((role or "", text or ""))
        turns = sorted({*sides[0], *sides[1]})
        common = 0
        while common < len(turns) and sides[0].get(turns[common]) == sides[1].get(turns[common]):
            common += 1
        parts = {"prompt": (sides[0], turns[:common]), "chosen": (sides[0], turns[common:]), "rejected": (sides[1], turns[common:])}
        chars = [sum(len(render(*m)) for t in own for m in s.get(t, ())) for s, own in parts.values()]
        for part, (s, own) in parts.items():
            start = 0
            for t in own:
                for role, text in sorted(s.get(t, ())):
                    trained = part != "prompt" and role == "assistant"
                    body = render(role, text)
                    span = (body.index("\n") + 1, len(body) - 1) if trained else (0, 0)
                    out.append((pair, t, part, role, body, *span, start, *chars))
                    start += len(body)
    return sorted(out)


def test_matches_a_plain_version(spark):
    rng = random.Random(6)
    chosen, rejected = [], []
    for pair in range(40):
        turns = [(t, "user" if t % 2 == 0 else "assistant", rng.choice(["a", "b", "é \n", ""])) for t in range(rng.randint(0, 7))]
        fork = rng.randint(0, 7)
        chosen += [(pair, *t) for t in turns]
        rejected += [(pair, t, r, x if t < fork else x + "!") for t, r, x in turns][: rng.randint(1, 8)]
    chosen += [(50, 0, None, None), (51, 3, "user", "x"), (51, 3, "user", "x"), (51, 3, "assistant", "tie")]
    rejected += [(50, 0, None, None), (52, 0, "assistant", "only here" * 5000)]
    got = format_preferences(side(spark, chosen), side(spark, rejected)).collect()
    assert sorted(map(tuple, got)) == plain(chosen, rejected)


def test_long_and_sparse_conversations(spark):
    """Starts across stretches of turns, of both levels and below zero."""
    rng = random.Random(3)
    turns = sorted({*range(-3, 2500), *(rng.randrange(-(1 << 40), 1 << 40) for _ in range(200)), *range(1 << 20, (1 << 20) + 50)})
    chosen = [(1, t, "assistant" if t % 2 else "user", "x" * (t % 7)) for t in turns]
    rejected = [(p, t, r, x if t < 1500 else x + "é") for p, t, r, x in chosen] + [(1, 1600, "user", "second"), (1, 1600, "assistant", "third")]
    wide = SIDE.replace("turn int", "turn long")
    sides = [spark.createDataFrame([(*r, "x", "y") for r in rows], wide) for rows in (chosen, rejected)]
    got = format_preferences(*sides).collect()
    assert sorted(map(tuple, got)) == plain(chosen, rejected)
    for part in ("prompt", "chosen", "rejected"):
        rows = sorted((r for r in got if r.part == part), key=lambda r: r.start)
        whole = "".join(r.rendered for r in rows)
        assert len(whole) == rows[0][f"{part}_chars"]
        assert all(whole[r.start : r.start + len(r.rendered)] == r.rendered for r in rows)


def test_odd_rows_and_empty_tables(spark):
    rows = [(None, 0, "user", "x"), (1, None, "user", "x"), (1, 0, "user", "hi")]
    empty = side(spark, [])
    assert [r.part for r in format_preferences(side(spark, rows), side(spark, rows)).collect()] == ["prompt"]
    assert [r.part for r in format_preferences(side(spark, rows), empty).collect()] == ["chosen"]
    assert format_preferences(empty, empty).count() == 0


def test_branches_change_the_last_reply(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "q2"), (1, 3, "assistant", "b"), (2, 0, "user", "q"), (2, 1, "assistant", "a"), (3, 0, "user", "q")]
    chosen, rejected = branches(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    assert chosen.count() == len(rows)
    assert sorted((r.pair_id, r.turn, r.text) for r in rejected.collect()) == [(1, 0, "q"), (1, 1, "a"), (1, 2, "q2"), (1, 3, "a"), (2, 0, "q"), (3, 0, "q")]


def test_the_plan_is_native(spark):
    plan = QUERIES["op2_preference_formatting"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_texts_are_shuffled_once(spark):
    """Only the exchange by pair and turn, and its reuses, carry messages."""
    conversations = spark.read.parquet(f"{SF}/conversations.parquet").withColumnRenamed("conv_id", "pair_id")
    found = format_preferences(conversations, conversations)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan()
    carrying = []

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            return walk(node.plan())
        if node.nodeName() == "Exchange" and any(node.output().apply(i).dataType().simpleString()[:5] in ("array", "struc", "strin", "binar") for i in range(node.output().size())):
            carrying.append(node)
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    assert len({n.id() for n in carrying}) == 1
