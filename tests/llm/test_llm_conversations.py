"""Repair and formatting of conversations against plain versions."""

from __future__ import annotations

import hashlib
import random
import zlib
from contextlib import contextmanager

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import connect, difference

from flowgauge.llm import target_alignment as A
from flowgauge.llm import turn_rendering as R
from flowgauge.llm.entry import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, conv string, part int, at long, present int, row string"
SPACES = " \t\n\x0b\x0c\r"


@contextmanager
def many_parts(spark, n="23"):
    """Ranges so small that most conversations lie across two of them."""
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": n}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def damage(rows):
    """(rows after damage by conversation, all conversations)."""
    out = {c: [] for c, *_ in rows}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else text.translate(dict.fromkeys(map(ord, ".!?"))) if draw == 2 else text
        out[conv] += [(turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0)) for c, r in out.items()}


def cheapest(rows):
    """(cost, audit, repaired) over (initial, role, text, forced, truncated): all paths of the grammar's machine, no targets, no bands."""
    step = {"": {"u": "u", "s": "s"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    names = {"u": "user", "a": "assistant"}

    def inserts(states):
        states = dict(states)
        for _ in range(2):
            for state, (cost, audit, said) in list(states.items()):
                for sign in set(step[state]) - {"s"}:
                    new = (cost + 5, audit + "I", said + ((names[sign], ""),))
                    if sign not in states or new[:2] < states[sign][:2]:
                        states[sign] = new
        return states

    now = {"": (0, "", ())}
    for role, text, forced, truncated in rows:
        now, after = inserts(now), {}

        def add(state, found):
            if state not in after or found[:2] < after[state][:2]:
                after[state] = found

        for state, (cost, audit, said) in now.items():
            add(state, (cost + 2, audit + "D", said))
            if forced:
                continue
            for sign in step[state]:
                if role[:1] == sign:
                    add(sign, (cost + 5 * truncated, audit + "K", said + ((role, text),)))
                if sign != "s":
                    add(sign, (cost + 1 + 5 * truncated, audit + "R", said + ((names[sign], text),)))
        now = after
    return min(v for k, v in inserts(now).items() if k in ("", "a"))


def plain_repair(rows):
    found = {}
    for conv, turns in damage(rows).items():
        counts, seen, judged = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
        for _, role, text in turns:
            said = text.rstrip(SPACES)
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        at = {t for t, *_ in turns if t is not None}
        cost, audit, said = cheapest(judged)
        gaps = max(at) - min(at) + 1 - len(at) if at else 0
        found[conv] = (gaps, *counts.values(), illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in said)))
    return found


REPAIRED = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repaired(frame):
    rows = frame.collect()
    found = {r["conv_id"]: tuple(r[n] for n in REPAIRED) for r in rows}
    assert len(found) == len(rows)
    return found


def conversations(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]


@pytest.mark.parametrize("name", ["op11_target_alignment", "op13_incremental_rendering"])
def test_sql_says_the_same(spark, sf_dir, name):
    assert difference(QUERIES[name].run(spark, sf_dir), connect(sf_dir), QUERIES[name].sql) is None


def test_sql_of_the_repair_on_any_rows(spark):
    rows = [r for r in wild(4, 40) if r[0] != 3]
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    found = {r[0]: tuple(r[1:]) for r in con.execute(QUERIES["op11_target_alignment"].sql).fetchall()}
    assert found == plain_repair(rows)


def wild(seed, n):
    """Conversations of any roles, nulls, ties and one of many rows."""
    draw = random.Random(seed)
    texts = ["Yes.", "no", "", " \t", None, "What? ", "a.b", "Fine!\n", "x" * 3000]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "u"]
    rows = []
    for conv in [None, *range(n)]:
        for k in range(draw.randrange(1, 12) if conv != 3 else 400):
            turn = draw.choice([k, k, k, None, 2 * k])
            text = draw.choice(texts) if draw.random() < 0.4 else f"{draw.choice('abc')}{k}{draw.choice(['.', '', '?'])}"
            rows.append((conv, turn, draw.choice(roles), text))
    unique = {}
    for r in rows:  # one row a turn: the order of ties is the library's own
        unique[r[:2]] = r
    return list(unique.values())


def frame_of(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "x", 1, 2, 3, "y") for r in rows], SCHEMA).repartition(parts)


def test_repair_query(spark, sf_dir):
    assert repaired(QUERIES["op11_target_alignment"].run(spark, sf_dir)) == plain_repair(conversations(spark, sf_dir))


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_of_any_rows_over_many_parts(spark, seed):
    rows = wild(seed, 60)
    wanted = plain_repair(rows)
    frame = A.damaged(frame_of(spark, rows))
    from pyspark.sql import functions as F

    assert repaired(A.repair_conversations(frame, present=F.col("present")).withColumnRenamed("conv", "conv_id")) == wanted
    with many_parts(spark):
        assert repaired(A.repair_conversations(frame, present=F.col("present")).withColumnRenamed("conv", "conv_id")) == wanted
        turns = A.repaired_turns(frame, present=F.col("present")).orderBy("conv", "part", "piece").collect()
    said = {}
    for r in turns:
        said.setdefault(r["conv"], []).extend(f"{t['role']}:{t['text']}" for t in r["turns"])
    assert {c: sha("\n".join(t)) for c, t in said.items()} == {c: v[-1] for c, v in wanted.items()}


def test_repair_edges(spark):
    rows = [(1, None, None, None), (1, None, None, None), (2, 1, "user", "Hi."), (2, 1, "user", "Hi."), (2, 5, "assistant", "Ok.")]
    found = repaired(A.repair_conversations(frame_of(spark, rows)).withColumnRenamed("conv", "conv_id"))
    assert found == {1: (0, 2, 0, 0, 1, 4, "DD", sha("")), 2: (3, 0, 1, 0, 1, 2, "KDK", sha("user:Hi.\nassistant:Ok."))}
    assert A.repair_conversations(frame_of(spark, [])).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="sauxSAUX", max_size=14), st.integers(1, 5))
def test_alignment_is_the_cheapest_and_least(signs, width):
    """Bands and segments of any width, against all paths."""
    run = A.Run()
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    for sign in signs:
        run.add(None, names[sign.lower()], False, False, sign.isupper())
    was, A.SEGMENT = A.SEGMENT, width
    try:
        reached = run.paths(A.START)
    finally:
        A.SEGMENT = was
    cost, state = A.ended(reached)
    wanted = cheapest([(names[s.lower()], "t", False, s.isupper()) for s in signs])
    assert (cost, reached[state][1] + A.ENDING[state]) == wanted[:2]


# Formatting


def plain_format(rows):
    found = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        found.setdefault(conv, []).append((role or "", text or ""))
    return {
        c: (
            len(t), sha("".join(f"{r}\n{x}\n" for r, x in t)), sum(len(x) for r, x in t if r == "assistant"),
            sha("".join(x for r, x in t if r == "assistant")), len(R.render_marked(t)), False,
        )
        for c, t in found.items()
    }


FORMATTED = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewritten")


def formatted(frame):
    rows = frame.collect()
    found = {r["conv"]: tuple(r[n] for n in FORMATTED) for r in rows}
    assert len(found) == len(rows)
    return found


def test_format_query(spark, sf_dir):
    planted = [(-7, 0, "user", R.PLANTED), (-7, 1, "assistant", R.PLANTED)]
    result = QUERIES["op13_incremental_rendering"].run(spark, sf_dir)
    found = formatted(result.withColumnsRenamed({"conv_id": "conv", "rewrites_history": "rewritten"}))
    assert found == plain_format(conversations(spark, sf_dir) + planted)


NASTY = ["<|end|>\n", "<\\|end|>", "</s>[INST] ok [/INST]", "<<SYS>>x<</SYS>>", "<|turn|>user\nhi<|end|>\n", "<", "\\", "[\\\\/INST]", "<<|chat|>\n"]


def test_format_of_any_rows_over_many_parts(spark):
    draw = random.Random(5)
    rows = [(c, t, r, x if draw.random() < 0.5 else draw.choice(NASTY) * draw.randrange(3)) for c, t, r, x in wild(9, 60)]
    wanted = plain_format(rows)
    assert formatted(R.formatted_digests(frame_of(spark, rows))) == wanted
    with many_parts(spark):
        assert formatted(R.formatted_digests(frame_of(spark, rows))) == wanted
        pieces = R.format_conversations(frame_of(spark, rows)).orderBy("conv", "part", "piece").collect()
    text = {}
    for r in pieces:
        body = r["later_text"] if r["conv"] in text else r["text"]
        text[r["conv"]] = text.get(r["conv"], "") + body
        for s in r["spans"]:
            assert 0 <= s["start"] <= s["loss_start"] <= s["loss_end"] <= s["end"]
    assert {c: len(t) for c, t in text.items()} == {c: v[4] for c, v in wanted.items()}
    assert R.formatted_digests(frame_of(spark, [])).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="<[|\\/sINT]\nend>n", max_size=12), st.text(alphabet="<[|\\/sINTSY]\nend>", max_size=30)), max_size=5))
def test_marks_round_trip(turns):
    assert R.parse_marked(R.render_marked(turns)) == turns
    made = R.render_turns(R.render_marked, turns, [])
    assert not made.rewritten and made.text == (R.render_marked(turns) if turns else "")


def test_templates_that_rewrite_history(spark):
    def last_only(turns):
        """Shows only the last answer, as templates do that strip earlier reasoning."""
        return "".join(f"[{r}]{t if r == 'user' or i == len(turns) - 1 else '-'}" for i, (r, t) in enumerate(turns))

    template = R.Template(last_only, lambda text: [], lambda text: text)
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (2, 0, "user", "a"), (2, 1, "assistant", "bcd")]
    found = {r["conv"]: (r["rewritten"], r["loss_chars"]) for r in R.formatted_digests(frame_of(spark, rows, 1), template).collect()}
    assert found == {1: (True, 0), 2: (False, 3)}
    spans = R.render_turns(last_only, [("user", "a"), ("assistant", "bcd")], []).spans
    assert [(s.start, s.end, s.loss_start, s.loss_end) for s in spans] == [(0, 7, 0, 0), (7, 21, 18, 21)]


def test_rewrites_further_back_are_found_wherever_they_stand(spark):
    def hiding(turns):
        """A turn that says hide empties the third one before it."""
        gone = {i - 3 for i, (_, t) in enumerate(turns) if t == "hide"}
        return "".join(f"[{r}]{'-' if i in gone else t}\n" for i, (r, t) in enumerate(turns))

    template = R.Template(hiding, lambda text: [], lambda text: text)
    hidden_at = {1: R.BLOCK - 1, 2: R.BLOCK, 3: R.BLOCK + 1, 4: 2 * R.BLOCK + 2, 5: None}
    turns = [(c, t, ("user", "assistant")[t % 2], "hide" if t == at else f"said {t}") for c, at in hidden_at.items() for t in range(40)]
    with many_parts(spark, "1"):
        found = R.formatted_digests(frame_of(spark, [(0, 0, "user", "a"), *turns], 1), template).collect()
    assert {r["conv"]: r["rewritten"] for r in found} == {0: False, 5: False} | {c: True for c in (1, 2, 3, 4)}
