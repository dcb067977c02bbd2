"""Chat formatting: round trips, the role machine, blocks, plans."""

import random

import pytest
from pyspark.sql import functions as F

from martcraft.llm import chat
from martcraft.llm.chat import Role, Template

T = Template()
SCHEMA = "conv_id long, turn long, role string, text string"


def formatted(spark, rows, template=T):
    out = chat.format_chats(spark.createDataFrame(rows, SCHEMA), template)
    return {r.conv_id: r for r in out.withColumn("back", template.read_back(F.col("formatted")))
            .withColumn("learned", template.learned(F.col("segments"))).collect()}


def test_format_of_a_conversation(spark):
    r = formatted(spark, [(1, 1, "user", "hi"), (1, 0, "system", "be [kind]"), (1, 2, "assistant", "[/INST] yes</s>")])[1]
    assert r.formatted == r"<s>[SYS]be [kind][/SYS][INST]hi[/INST][ANS][\/INST] yes<\/s></s>"
    assert [(s.text, s.loss) for s in r.segments if s.loss] == [(r"[\/INST] yes<\/s>", True)]
    assert "".join(s.text for s in r.segments) == r.formatted
    assert r.learned == "[/INST] yes</s>" and r.in_order


def test_hostile_texts_come_back(spark):
    rng = random.Random(11)
    bits = T.marks() + ["\\", "\\\\", "[", "<", "]", ">", "/", "s>", "INST]", " ", "\n", "é", "😀", "[\\INST]", "<\\\\s>", "$1", ""]
    rows, want, text = [], {}, lambda: "".join(rng.choice(bits) for _ in range(rng.randrange(9)))
    for c in range(300):
        turns = [(rng.choice(["user", "assistant", "system", "tool", "", text()]), text()) for _ in range(rng.randrange(1, 7))]
        rows += [(c, t, *x) for t, x in enumerate(turns)]
        want[c] = turns
    rng.shuffle(rows)
    got = formatted(spark, rows)
    for c, turns in want.items():
        assert [(x.role, x.text) for x in got[c].back] == turns
        assert got[c].learned == "".join(t for role, t in turns if role == "assistant")
        texts = [s.text for s in got[c].segments[2::3]]
        assert not any(m in t for t in texts for m in T.marks())


def test_machine(spark):
    legal = {"u": True, "ua": True, "sua": True, "uau": True, "s": True, "a": False, "uu": False, "us": False, "uaa": False,
             "ss": False, "sa": False, "uax": False, "x": False}
    names = {"u": "user", "a": "assistant", "s": "system", "x": "tool"}
    rows = [(i, t, names[c], "x") for i, word in enumerate(legal) for t, c in enumerate(word)]
    got = formatted(spark, rows)
    assert [got[i].in_order for i in range(len(legal))] == list(legal.values())


def test_long_conversation_spans_blocks(spark):
    n = 5 * chat.BLOCK + 7
    rows = [(7, t, "assistant" if t % 2 else "user", f"t{t}") for t in range(n)] + [(8, 3, "user", "q"), (8, 900, "user", "r")]
    convs = spark.createDataFrame(rows, SCHEMA).repartition(8)
    got = formatted(spark, rows)
    assert [(x.role, x.text) for x in got[7].back] == [(r[2], r[3]) for r in rows[:n]] and got[7].in_order
    assert not got[8].in_order
    wrong = chat.segments(convs).where("not in_order and part = 1").collect()
    assert [(r.conv_id, r.text) for r in wrong] == [(8, "r")]
    order = chat.segments(convs).where("conv_id = 7 and loss").orderBy("block", "place", "part").collect()
    assert [r.text for r in order] == [f"t{t}" for t in range(1, n, 2)]


def test_nulls_ties_repeats_and_extra_columns(spark):
    rows = [(None, 0, "user", None), (None, 1, "assistant", "b"), (1, None, "user", "z"), (1, 0, None, "a"), (1, 0, "user", "b"),
            (1, 0, "user", "a"), (1, 0, "user", "a"), (2, -300, "user", ""), (2, -1, "assistant", "")]
    df = spark.createDataFrame([(*r, 1, "x", True, 0, "s") for r in rows], SCHEMA + ", block int, formatted string, real boolean, place int, last string")
    got = {r.conv_id: [(t.role, t.text) for t in r.back] for r in chat.format_chats(df).withColumn("back", T.read_back(F.col("formatted"))).collect()}
    assert got == {None: [("user", ""), ("assistant", "b")], 2: [("user", ""), ("assistant", "")],
                   1: [("user", "z"), ("", "a"), ("user", "a"), ("user", "a"), ("user", "b")]}
    assert chat.format_chats(df.limit(0)).count() == 0 and chat.segments(df.limit(0)).count() == 0


def test_very_long_text(spark):
    text = "[INST] word </s> " * 200_000
    r = formatted(spark, [(1, 0, "user", text), (1, 1, "assistant", text)])[1]
    assert r.learned == text and [t.text for t in r.back] == [text, text]


def test_templates(spark):
    own = Template((Role("q", "{Q}", "{q}", False, (chat.START, "r")), Role("r", "{R}", "{r}", True, ("q",))), "{0}", ("{N}", "{n}", "{e}"))
    r = formatted(spark, [(1, 0, "q", "{Q}{\\R}"), (1, 1, "r", "*{0}*"), (1, 2, "{N}", "")], own)[1]
    assert r.formatted == r"{0}{Q}{\Q}{\\R}{q}{R}*{\0}*{r}{N}{\N}{n}{e}"
    assert [(t.role, t.text) for t in r.back] == [("q", "{Q}{\\R}"), ("r", "*{0}*"), ("{N}", "")]
    for bad in ("[IN", "x", "[a[b]", "[a\\]", "[INST]"):
        with pytest.raises(ValueError):
            Template(begin=bad)


def test_plan_is_native(spark):
    from martcraft.llm import registry
    plan = registry.op11_chat(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
