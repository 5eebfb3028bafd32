"""Operator 6: reading back what was written, turn by turn."""
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from riskframe.llm import chat_format
from riskframe.llm.chat_format import Codec, Template
from riskframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    by = {}
    first = lambda x: (x is not None, x)  # noqa: E731  nulls come first
    for conv, turn, role, text in sorted(rows, key=lambda r: (first(r[1]) if r[1] is not None else (False, 0), r[2] or "", r[3] or "")):
        by.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        learned = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned))
    return out


def digest(r):
    return r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: r for r in QUERIES["op6_chat_format"](spark, SF).collect()}
    want = expected(rows + chat_format.PROBE)
    assert {k: digest(r) for k, r in got.items()} == want
    assert got[-7]["bad_turn"] == -1 and got[-7]["formatted_chars"] > 44


ODD = ["", None, "</s>", "<s>[INST]", "<\\s>", "\\", "\\\\", "<", "[/INST", "]", "<</s>", "[ROLE][TEXT][/ROLE]", "a\nb", "é\U0001f600", "<s><s>", "[[INST]]", "\x00"]


@pytest.mark.parametrize("part_chars", [10, 1 << 20])
def test_every_kind_of_row(spark, part_chars):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["system", "user", "assistant", "tool", "</s>", "", None]), rng.choice(ODD) or None if rng.random() < 0.5 else rng.choice(ODD))
            for c in [*range(30), None] for t in range(rng.randrange(1, 9))]
    rows += [(500, t, ("user", "assistant")[t % 2], f"turn {t} " + "x" * 50) for t in range(3000)]  # one long conversation
    rows += [(501, 1, "user", "b"), (501, 1, "user", "a"), (501, 1, "user", "a"), (501, None, "system", "first")]
    turns = spark.createDataFrame(rows, SCHEMA).withColumn("part", F.lit("x")).withColumn("formatted", F.lit(1))
    parts = chat_format.format_turns(turns, part_chars=part_chars)
    got = {r["conv_id"]: r for r in chat_format.read_back(parts).collect()}
    assert {k: digest(r) for k, r in got.items()} == expected(rows)
    assert got[500]["bad_turn"] == -1 and got[501]["bad_turn"] == 2
    if part_chars == 10:
        assert parts.where("conv_id = 500").count() > 100


@pytest.mark.parametrize("roles,bad", [("ua", -1), ("sua", -1), ("suaua", -1), ("au", 0), ("uu", 1), ("u", 1), ("sa", 1), ("uas", 2), ("t", 0)])
def test_state_machine(spark, roles, bad):
    names = {"u": "user", "a": "assistant", "s": "system", "t": "tool"}
    turns = spark.createDataFrame([(1, i, names[r], "x") for i, r in enumerate(roles)], SCHEMA)
    assert chat_format.format_turns(turns).first()["bad_turn"] == bad


def test_escape_is_reversible_and_hides_marks():
    codec, rng = Codec(Template()), random.Random(8)
    pieces = [*Template().marks(), "\\", "<", "s>", "[", "]", "/", "a"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(9)))
        hidden = codec.escape(text)
        assert codec.unescape(hidden) == text and not codec.mark.search(hidden)


def test_loss_spans_point_at_assistant_text(spark):
    turns = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "ans </s>")], SCHEMA)
    r = chat_format.format_turns(turns).first()
    a, b = r["loss_spans"]
    assert r["formatted"][a:b] == "ans <\\/s>"


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert chat_format.read_back(chat_format.format_turns(none)).count() == 0
    assert chat_format.read_back(chat_format.format_turns(chat_format.with_probe(none))).count() == 1
