"""Repair of conversations by Wagner-Fischer alignment to the alternating grammar.

A conversation is legal if its roles follow the grammar `(s?(ua)+)?` by their
initials. Each string of the grammar of a feasible length is a target, and the
rows are aligned to it by edit distance: keep 0, rerole 1, delete 2, insert 5,
and 5 more for a truncated row that stays. A table covers only Ukkonen's band: the
cells that a path no dearer than the best target so far can pass. Lengths whose
difference alone costs more are not tried. The backtrace of a table gives the
least audit (the initials of the edits) among its cheapest paths; audits of
equally cheap targets are compared.

A blank row and a later row of the same role and text must go. Such rows need no
alignment: in the least audit their D follows the row before at once.

Long conversations are aligned in segments of SEGMENT rows: from each state of
the grammar to each other, again over all feasible lengths. Segments never end in
an insert, so a path has one division into segments and no audit is the beginning
of another; the cheapest and least chain of segments is therefore that of the whole
conversation, and rows of one conversation may lie in many tasks. What passes on
between ranges are costs and ranks of audits for 4 x 4 states.

Rows are sorted over the whole table by ranges (`turns.py`). A conversation of
bounded size inside a range is finished there. The rows of others are written with
their places, first rows of equal role and text are found by a shuffle, and their
repaired texts come together in pieces, as a stream.

Null roles and texts count as one space. Rows go by turn, nulls first, then role,
then a hash of the text; null ids are one conversation; repeated rows are
duplicates. A conversation without rows has zeros, an empty audit and the digest of
no bytes. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.entry import query, table
from flowgauge.llm.turns import batches_of, in_order, rows_of, turns_of
from flowgauge.sources.scratch import written

REROLED, DELETED, INSERTED, STUB = 1, 2, 5, 5
SEGMENT = 32
KNOWN = 50_000
WHOLE_ROWS, WHOLE_CHARS, PIECE_CHARS = 4_096, 1 << 20, 1 << 18
SPACE = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}
ROLES = {"u": "user", "a": "assistant"}

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
FOLLOWS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
SIGN = {SYSTEM: "s", USER: "u", ASSISTANT: "a"}
# Inserts that end a conversation in each state: to the end of the grammar's string.
ENDING = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}


def gap_cost(rows: int, signs: int) -> int:
    """The least that a difference in length costs."""
    return INSERTED * max(0, signs - rows) + DELETED * max(0, rows - signs)


def banded(rows: str, target: str, limit: int) -> tuple[int, str] | None:
    """Cheapest cost and its least audit, if no more than the limit; the last edit is no insert.

    A row is its role's initial, in capitals if it is truncated. Cell (i, j) holds
    the cost of aligning what follows row i and sign j.
    """
    n, m = len(rows), len(target)
    slack = (limit - gap_cost(n, m)) // (DELETED + INSERTED)
    if slack < 0:
        return None
    low, high, far = min(0, m - n) - slack, max(0, m - n) + slack, limit + 1
    togo = [[far] * (m + 2) for _ in range(n + 1)]
    togo[n][m] = 0
    for i in range(n - 1, -1, -1):
        here, below = togo[i], togo[i + 1]
        stub = STUB if rows[i].isupper() else 0
        sign = rows[i].lower()
        for j in range(min(m, i + high), max(0, i + low) - 1, -1):
            best = below[j] + DELETED
            if j < m:
                if target[j] == sign:
                    best = min(best, below[j + 1] + stub)
                elif target[j] != "s":
                    best = min(best, below[j + 1] + stub + REROLED)
                if target[j] != "s":
                    best = min(best, here[j + 1] + INSERTED)
            here[j] = min(best, far)
    if togo[0][0] > limit:
        return None
    return togo[0][0], _backtrace(rows, target, togo)


def _backtrace(rows: str, target: str, togo: list[list[int]]) -> str:
    """The least string of edits along cells that lie on a cheapest path."""
    i, j, audit = 0, 0, []
    while i < len(rows):
        left = togo[i][j]
        if togo[i + 1][j] + DELETED == left:
            audit.append("D")
            i += 1
        elif j < len(target) and target[j] != "s" and togo[i][j + 1] + INSERTED == left:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if rows[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return "".join(audit)


def _targets(state: int, n: int) -> list[tuple[int, int, str]]:
    """(least cost, end state, signs) of the grammar's strings from a state that n rows can reach, likeliest first.

    One insert before a row is enough to change whose turn it is, so no target has more than 2 n + 1 signs.
    """
    found = []
    for lead in ("", "s") if state == START else ("",):
        at, signs = (SYSTEM, lead) if lead else (state, "")
        while len(signs) <= 2 * n + 1:
            found.append((gap_cost(n, len(signs)), at, signs))
            at = FOLLOWS[at]
            signs += SIGN[at]
    return sorted(found)


@lru_cache(maxsize=KNOWN)
def align(rows: str, state: int) -> dict[int, tuple[int, str]]:
    """For each state that the rows can end in, the least cost and then the least audit over all target lengths."""
    n, best = len(rows), {}
    for least, end, target in _targets(state, n):
        if "s" in target and "s" not in rows.lower():
            continue
        most = best[end][0] if end in best else (DELETED + INSERTED + STUB) * n + INSERTED * len(target)
        limit = min(most, least + 2 * (DELETED + INSERTED))
        while least <= most:
            found = banded(rows, target, limit)
            if found is not None:
                best[end] = min(found, best.get(end, found))
            if found is not None or limit >= most:
                break
            limit = min(most, 2 * limit)
    return best


@dataclass
class Run:
    """Rows of one conversation in one part: faults, turns, and the rows to align with the D that follow each."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    least: int | None = None
    most: int | None = None
    first: str | None = None
    last: str | None = None
    rows: list[str] = field(default_factory=list)
    forced: list[int] = field(default_factory=lambda: [0])

    def add(self, turn: int | None, role: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        if turn is not None and turn != self.most:
            self.turns, self.most = self.turns + 1, turn
            self.least = turn if self.least is None else self.least
        sign = role[:1]
        if self.last is not None:
            self.illegal += self.last + sign not in LEGAL
        self.first = sign if self.first is None else self.first
        self.last = sign
        self.blank += blank
        self.duplicate += duplicate
        if blank or duplicate:
            self.forced[-1] += 1
            return
        self.truncated += truncated
        known = sign if sign in ("s", "u", "a") else "x"
        self.rows.append(known.upper() if truncated else known)
        self.forced.append(0)

    def paths(self, state: int) -> dict[int, tuple[int, str]]:
        """Least cost and audit from a state to each that the rows can end in, segment by segment."""
        reached = {state: (0, "")}
        for at in range(0, len(self.rows), SEGMENT):
            pattern, after = "".join(self.rows[at : at + SEGMENT]), {}
            for here, (cost, audit) in reached.items():
                for end, (more, edits) in align(pattern, here).items():
                    found = (cost + more, audit + edits)
                    after[end] = min(found, after.get(end, found))
            reached = after
        return {end: (cost + DELETED * sum(self.forced), self._with_forced(audit)) for end, (cost, audit) in reached.items()}

    def _with_forced(self, audit: str) -> str:
        if not any(self.forced):
            return audit
        out, i = ["D" * self.forced[0]], 0
        for edit in audit:
            out.append(edit)
            if edit != "I":
                i += 1
                out.append("D" * self.forced[i])
        return "".join(out)


def ended(reached: dict[int, tuple]) -> tuple[int, int]:
    """(cost, state) of the best end: by cost, then by what stands in second place, an audit or its rank."""
    closing = {state: (v[0] + INSERTED * len(ENDING[state]), v[1]) for state, v in reached.items()}
    state = min(closing, key=closing.__getitem__)
    return closing[state][0], state


def replay(audit: str, rows: Iterator[tuple[str, str]], state: int) -> Iterator[tuple[str, str]]:
    """The repaired turns that the edits make of the rows."""
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        state = SYSTEM if edit == "K" and state == START and role[:1] == "s" else FOLLOWS[state]
        yield (role if edit == "K" else ROLES[SIGN[state]]), text


def _key(role: str, text: str) -> bytes:
    """A 128-bit digest of role and text."""
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def _judged(row: dict) -> tuple[str, str, bool, bool]:
    """Role, text, whether blank, whether truncated; nulls count as one space."""
    role = " " if row["role"] is None else row["role"]
    text = " " if row["text"] is None else row["text"]
    said = text.rstrip(SPACE)
    return role, text, not said, bool(said) and said[-1] not in ".!?"


def _line(turn: tuple[str, str]) -> str:
    return f"{turn[0]}:{turn[1]}"


def _small(conv: object, rows: list[dict], keep: bool) -> dict:
    """The whole repair of a conversation whose rows are all here."""
    run, seen, said = Run(), set(), []
    for row in rows:
        role, text, blank, truncated = _judged(row)
        key = None if blank else _key(role, text)
        run.add(row["turn"], role, blank, key in seen, truncated)
        if not blank:
            seen.add(key)
        said.append((role, text))
    reached = run.paths(START)
    cost, state = ended(reached)
    audit = reached[state][1] + ENDING[state]
    turns = list(replay(audit, iter(said), START))
    gaps = 0 if run.least is None else run.most - run.least + 1 - run.turns
    row = {"conv": conv, "gaps": gaps, "cost": cost, "audit": audit} | {n: getattr(run, n) for n in ("blank", "duplicate", "truncated", "illegal")}
    if keep:
        return row | {"turns": [{"role": r, "text": t} for r, t in turns]}
    return row | {"repaired_sha256": hashlib.sha256("\n".join(map(_line, turns)).encode()).hexdigest()}


_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_FACTS = [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
_RESULT = [*_FACTS, ("audit", pa.string()), ("repaired_sha256", pa.string()), ("turns", _TURNS)]
_RAW = [
    ("place", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("present", pa.bool_()),
    ("key", pa.binary()), ("truncated_row", pa.bool_()),
]
_FACTS_DDL = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_RESULT_DDL = f"{_FACTS_DDL}, repaired_sha256 string, turns array<struct<role:string,text:string>>"
_RAW_DDL = "place bigint, turn bigint, role string, text string, present boolean, key binary, truncated_row boolean"
PART_ROWS = 40  # bits; a part has fewer rows than that


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _task(work: Callable[[Iterator[dict]], Iterator[dict]], fields: list, most: int = 512) -> Task:
    """A mapInArrow function from one over rows; the type of the id is that of the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return

        def every() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        schema = pa.schema([("conv", first.schema.field("conv").type), *fields])
        yield from batches_of(work(rows_of(every(), most)), schema)

    return run


def _sorted_part(keep: bool) -> Callable[[Iterator[dict]], Iterator[dict]]:
    """Results of the small conversations inside a part; the rows of all others, with their places."""

    def raw(row: dict, at: int) -> dict:
        role, text, blank, truncated = _judged(row)
        key = None if blank or not row["present"] else _key(role, text)
        place = (row["part"] << PART_ROWS) + at
        out = {"conv": row["conv"], "done": False, "part": row["part"], "place": place, "turn": row["turn"], "present": row["present"]}
        return out | {"role": role, "text": text if row["present"] else None, "key": key, "truncated_row": truncated}

    def work(rows: Iterator[dict]) -> Iterator[dict]:
        held, at, chars, conv, first, passing = [], 0, 0, None, True, False
        for number, row in enumerate(rows):
            if number == 0:
                conv, passing = row["conv"], True  # its beginning may lie in the part before
            elif row["conv"] != conv:
                if not passing:
                    yield _small(conv, [r for r in held if r["present"]], keep) | {"done": True, "part": row["part"]}
                conv, passing, held, chars = row["conv"], False, [], 0
            if passing:
                yield raw(row, number)
                continue
            held.append(row)
            chars += len(row["text"] or "")
            if len(held) > WHOLE_ROWS or chars > WHOLE_CHARS:
                passing = True
                yield from (raw(r, number - len(held) + 1 + k) for k, r in enumerate(held))
                held = []
            at = number
        yield from (raw(r, at - len(held) + 1 + k) for k, r in enumerate(held))  # it may go on in the next part

    return work


def _runs(rows: Iterator[dict]) -> Iterator[dict]:
    """One row for each conversation and part: facts, and the paths between all states with the ranks of their audits."""
    run, now = None, None

    def summary() -> dict:
        paths = []
        for state in STATES:
            found = run.paths(state)
            order = sorted(found, key=lambda end: found[end][1])
            paths += [{"a": state, "b": end, "cost": found[end][0], "rank": order.index(end), "audit": found[end][1]} for end in found]
        facts = ("blank", "duplicate", "truncated", "illegal", "turns", "least", "most", "first", "last")
        return {"conv": now[0], "part": now[1], "paths": paths} | {n: getattr(run, n) for n in facts}

    for row in rows:
        if now != (row["conv"], row["part"]):
            if run is not None:
                yield summary()
            run, now = Run(), (row["conv"], row["part"])
        if row["present"]:
            run.add(row["turn"], row["role"], row["blank"], not row["blank"] and not row["alive"], row["truncated_row"])
    if run is not None:
        yield summary()


def _chain(rows: Iterator[dict]) -> Iterator[dict]:
    """For each run of a conversation the states it leads between on the best chain, and the facts of the whole."""
    runs: list[dict] = []

    def best() -> Iterator[dict]:
        reached, links = {START: (0, 0)}, []
        for run in runs:
            after: dict[int, tuple[int, int, int, int]] = {}
            for p in run["paths"]:
                if p["a"] in reached:
                    cost, rank = reached[p["a"]]
                    found = (cost + p["cost"], rank, p["rank"], p["a"])
                    after[p["b"]] = min(found, after.get(p["b"], found))
            order = sorted(after, key=lambda end: after[end][1:3])
            links.append({end: v[3] for end, v in after.items()})
            reached = {end: (v[0], order.index(end)) for end, v in after.items()}
        cost, state = ended(reached)
        ways, end = [], state
        for link in reversed(links):
            ways.append((link[end], end))
            end = link[end]
        facts = _facts_of(runs) | {"cost": cost}
        for i, (run, (a, b)) in enumerate(zip(runs, reversed(ways))):
            last = i == len(runs) - 1
            yield {"conv": run["conv"], "part": run["part"], "a": a, "b": b, "ending": ENDING[state] if last else "", **facts}

    for row in rows:
        if runs and runs[0]["conv"] != row["conv"]:
            yield from best()
            runs = []
        runs.append(row)
    if runs:
        yield from best()


def _facts_of(runs: list[dict]) -> dict:
    facts = {n: sum(r[n] for r in runs) for n in ("blank", "duplicate", "truncated", "illegal")}
    turns, most, least, last = 0, None, None, None
    for r in runs:
        if last is not None and r["first"] is not None:
            facts["illegal"] += last + r["first"] not in LEGAL
        last = r["last"] if r["last"] is not None else last
        if r["least"] is not None:
            turns += r["turns"] - (r["least"] == most)
            least, most = (r["least"] if least is None else least), r["most"]
    return facts | {"gaps": 0 if least is None else most - least + 1 - turns}


def _replayed(rows: Iterator[dict]) -> Iterator[dict]:
    """Repaired turns of each run, in pieces; the decision stands before its rows."""
    for decision, present in _by_decision(rows):
        base = {k: decision[k] for k in ("conv", "part", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
        audit, held, chars, number = decision["audit"], [], 0, 0
        turns = replay(audit, ((r["role"], r["text"]) for r in present), decision["a"])
        for turn in turns:
            held.append({"role": turn[0], "text": turn[1]})
            chars += len(turn[1]) + len(turn[0])
            if chars >= PIECE_CHARS:
                yield base | {"piece": number, "audit": audit if number == 0 else "", "turns": held}
                held, chars, number = [], 0, number + 1
        if held or number == 0:
            yield base | {"piece": number, "audit": audit if number == 0 else "", "turns": held}


def _by_decision(rows: Iterator[dict]) -> Iterator[tuple[dict, Iterator[dict]]]:
    decision = next(rows, None)
    while decision is not None:
        following: list[dict] = []

        def present() -> Iterator[dict]:
            for row in rows:
                if row["audit"] is not None:
                    following.append(row)
                    return
                if row["present"]:
                    yield row

        stream = present()
        yield decision, stream
        for _ in stream:
            raise AssertionError("a row without an edit")
        decision = following[0] if following else None


def _digested(rows: Iterator[dict]) -> Iterator[dict]:
    """Pieces of a conversation, in order, to one row with the digest of its repaired text."""
    now, digest, audits, begun = None, None, [], False

    def closed() -> dict:
        return now | {"audit": "".join(audits), "repaired_sha256": digest.hexdigest(), "turns": None}

    for row in rows:
        if now is None or now["conv"] != row["conv"]:
            if now is not None:
                yield closed()
            now, digest, audits, begun = row, hashlib.sha256(), [], False
        audits.append(row["audit"])
        for turn in row["turns"]:
            digest.update(("\n" if begun else "").encode() + f"{turn['role']}:{turn['text']}".encode())
            begun = True
        row["turns"] = None
    if now is not None:
        yield closed()


def _solve_spanning(raw: DataFrame, id_type: str) -> DataFrame:
    """Pieces of the repaired conversations whose rows lie in several parts or are many."""
    firsts = raw.where("key is not null").groupBy("conv", "key").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("alive"))
    narrow = raw.select("conv", "part", "place", "turn", "role", "present", F.col("key").isNull().alias("blank"), "truncated_row")
    flagged = narrow.join(firsts, "place", "left").withColumn("alive", F.coalesce("alive", F.lit(False)))
    path = "array<struct<a:int,b:int,cost:bigint,rank:int,audit:string>>"
    run_ddl = f"conv {id_type}, part int, blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, least bigint, most bigint, first string, last string, paths {path}"
    path_type = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32()), ("audit", pa.string())]))
    run_fields = [("part", pa.int32()), *[(n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal", "turns", "least", "most")]]
    run_fields += [("first", pa.string()), ("last", pa.string()), ("paths", path_type)]
    by_run = flagged.repartition("conv", "part").sortWithinPartitions("conv", "part", "place")
    runs = written(by_run.mapInArrow(_task(_runs, run_fields), run_ddl), "runs")

    costs = runs.withColumn("paths", F.expr("transform(paths, p -> named_struct('a', p.a, 'b', p.b, 'cost', p.cost, 'rank', p.rank))"))
    way_fields = [("part", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("ending", pa.string()), *_FACTS]
    way_ddl = f"conv {id_type}, part int, a int, b int, ending string, {_FACTS_DDL.replace(', audit string', '')}"
    ordered = costs.repartition("conv").sortWithinPartitions("conv", "part")
    ways = ordered.mapInArrow(_task(_chain, way_fields), way_ddl)
    audits = runs.select("conv", "part", F.explode("paths").alias("p")).select("conv", "part", "p.a", "p.b", "p.audit")
    same = [F.col("w.conv").eqNullSafe(F.col("p.conv")), *[F.col(f"w.{n}") == F.col(f"p.{n}") for n in ("part", "a", "b")]]
    decided = ways.alias("w").join(audits.alias("p"), same).select("w.*", F.concat("p.audit", "w.ending").alias("audit"), F.lit(-1).cast("bigint").alias("place"))

    both = decided.drop("ending", "b").unionByName(raw.select("conv", "part", "place", "role", "text", "present"), allowMissingColumns=True)
    pieces_ddl = f"conv {id_type}, part int, piece int, {_FACTS_DDL}, turns array<struct<role:string,text:string>>"
    piece_fields = [("part", pa.int32()), ("piece", pa.int32()), *_FACTS, ("audit", pa.string()), ("turns", _TURNS)]
    return both.repartition("conv", "part").sortWithinPartitions("conv", "part", "place").mapInArrow(_task(_replayed, piece_fields), pieces_ddl)


def _parts(df: DataFrame, columns: dict[str, str], present: Column | None, keep: bool) -> tuple[DataFrame, DataFrame, str]:
    """Finished conversations, and the rows of the others; both read from one written table."""
    rows = turns_of(df.withColumn("__present", F.lit(True) if present is None else present), **columns, present="__present")
    placed = in_order(rows.withColumn("turn", F.col("turn").cast("bigint")))
    id_type = placed.schema["conv"].dataType.simpleString()
    schema = f"conv {id_type}, done boolean, part int, {_RESULT_DDL}, {_RAW_DDL}"
    fields = [("done", pa.bool_()), ("part", pa.int32()), *_RESULT, *_RAW]
    stored = written(placed.mapInArrow(_task(_sorted_part(keep), fields), schema), "conversations")
    raw = stored.where("not done").select("conv", "part", *[f for f, _ in _RAW])
    return stored.where("done"), raw, id_type


def repair_conversations(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: Column | None = None
) -> DataFrame:
    """One row a conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows where `present` is false count for nothing, but their conversation has a row.
    """
    done, raw, id_type = _parts(df, {"conv": conv, "turn": turn, "role": role, "text": text}, present, keep=False)
    pieces = _solve_spanning(raw, id_type)
    ordered = pieces.repartition("conv").sortWithinPartitions("conv", "part", "piece")
    spanning = ordered.mapInArrow(_task(_digested, _RESULT, 16), f"conv {id_type}, {_RESULT_DDL}")
    return done.select(spanning.columns).unionByName(spanning).drop("turns")


def repaired_turns(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: Column | None = None
) -> DataFrame:
    """conv, part, piece, audit, turns: the repaired turns; a long conversation has several rows, in order by part and piece."""
    done, raw, id_type = _parts(df, {"conv": conv, "turn": turn, "role": role, "text": text}, present, keep=True)
    pieces = _solve_spanning(raw, id_type).select("conv", "part", "piece", "audit", "turns")
    return done.select("conv", "part", F.lit(0).alias("piece"), "audit", "turns").unionByName(pieces)


def damaged(df: DataFrame) -> DataFrame:
    """The rows with the damage that their crc32 deals, and `present`, false for those it drops."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = df.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), (F.crc32(key) % 20).alias("draw"))
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("draw") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("draw") == 3, 2).otherwise(1)))
    changed = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("draw") != 0).alias("present"), copies.alias("copy"))
    return changed.drop("copy")


# The cheapest paths of the grammar's machine, row by row; the least audit goes with the least cost.
SQL = r"""
with recursive crc_table as (
  select list(list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t
  from range(256) r(i)
),
drawn as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    xor(list_reduce(list_prepend(4294967295, list_transform(
      string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda x: ord(x)::bigint)),
      lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 as draw
  from conversations, crc_table
),
damaged as (
  select conv_id, turn, case when draw = 4 then 'user' else role end as role,
    case draw when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from drawn, range(2) c(copy) where draw <> 0 and (copy = 0 or draw = 3)
),
ordered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i,
    not regexp_matches(text, '[^\x20\x09-\x0D]') as blank,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as last
  from damaged
),
judged as (
  select *, not blank and row_number() over (partition by conv_id, role, text order by i) > 1 as again,
    lag(left(role, 1)) over (partition by conv_id order by i) || left(role, 1) as pair
  from ordered
),
rows_ as (select *, blank or again as forced, not blank and not again and last not in ('.', '!', '?') as truncated from judged),
convs as (
  select c.conv_id, count(r.i) as n, count(*) filter (where r.blank) as blank, count(*) filter (where r.again) as duplicate,
    count(*) filter (where r.truncated) as truncated,
    count(*) filter (where r.pair is not null and r.pair not in ('su', 'ua', 'au')) as illegal,
    coalesce(max(r.turn) - min(r.turn) + 1 - count(distinct r.turn), 0) as gaps
  from (select distinct conv_id from conversations) c left join rows_ r on r.conv_id is not distinct from c.conv_id
  group by c.conv_id
),
edits(letter, inserts) as (values ('D', 0), ('K', 0), ('K', 1), ('R', 0), ('R', 1)),
paths(conv_id, i, state, cost, audit) as (
  select conv_id, 0::bigint, 0, 0::bigint, '' from convs
  union all
  select conv_id, i, state, cost, audit from (
    select p.conv_id, r.i, case when letter = 'D' then p.state when here = 0 and sign = 's' and letter = 'K' then 1 when here = 2 then 3 else 2 end as state,
      p.cost + 5 * inserts + case letter when 'D' then 2 else case letter when 'R' then 1 else 0 end + case when truncated then 5 else 0 end end as cost,
      p.audit || repeat('I', inserts) || letter as audit
    from (select *, case when inserts = 0 then state when state = 2 then 3 else 2 end as here from paths, edits) p
    join (select *, left(role, 1) as sign from rows_) r on r.conv_id is not distinct from p.conv_id and r.i = p.i + 1
    where letter = 'D' or not forced and (
      letter = 'K' and (sign = 's' and here = 0 and inserts = 0 or sign = 'u' and here <> 2 or sign = 'a' and here = 2)
      or letter = 'R' and sign <> case when here = 2 then 'a' else 'u' end)
  ) qualify row_number() over (partition by conv_id, i, state order by cost, audit) = 1
),
ended as (
  select c.*, p.cost + case p.state when 2 then 5 when 1 then 10 else 0 end as cost,
    p.audit || case p.state when 2 then 'I' when 1 then 'II' else '' end as audit
  from convs c join paths p on p.conv_id is not distinct from c.conv_id and p.i = c.n
  qualify row_number() over (partition by c.conv_id order by p.cost + case p.state when 2 then 5 when 1 then 10 else 0 end, p.audit || case p.state when 2 then 'I' when 1 then 'II' else '' end) = 1
),
letters as (
  select conv_id, place, letter, count(*) filter (where letter <> 'I') over w as i, count(*) filter (where letter <> 'D') over w as o
  from (select conv_id, unnest(string_split(audit, '')) as letter, generate_subscripts(string_split(audit, ''), 1) as place from ended where audit <> '')
  window w as (partition by conv_id order by place)
),
said as (
  select l.conv_id, l.o, l.letter, r.role, case when l.letter = 'I' then '' else r.text end as text,
    max(case when l.o = 1 and l.letter = 'K' and left(r.role, 1) = 's' then 1 else 0 end) over (partition by l.conv_id) as led
  from letters l left join rows_ r on r.conv_id is not distinct from l.conv_id and r.i = l.i and l.letter <> 'I'
  where l.letter <> 'D'
),
repaired as (
  select conv_id, string_agg(case when letter = 'K' then role when (o - led) % 2 = 1 then 'user' else 'assistant' end || ':' || text, chr(10) order by o) as whole
  from said group by conv_id
)
select e.conv_id, e.gaps, e.blank, e.duplicate, e.truncated, e.illegal, e.cost, e.audit, sha256(coalesce(r.whole, '')) as repaired_sha256
from ended e left join repaired r on r.conv_id is not distinct from e.conv_id
"""


@query("op11_target_alignment", SQL)
def op11(spark, sf_dir):
    rows = damaged(table(spark, sf_dir, "conversations"))
    found = repair_conversations(rows, present=F.col("present"))
    return found.withColumnRenamed("conv", "conv_id")
