"""Cheapest repair of conversations by a suffix-shared automaton over the signatures of their rows.

A row's symbol is its fault and the initial of its role. Edits must lead to the role initials ``(s?(ua)+)?``; that grammar has four states. What the rest of a
conversation costs depends on its remaining symbols and the grammar state alone, so all conversations share one automaton whose nodes are
suffixes: cost-to-go and best audit are computed once per node and grammar state (``walk``), however many conversations pass through it.

1. Equal rows of a turn are one row with a count. First turns of equal role and text tell duplicates. Rows get their symbol by expressions.
2. All rows are sorted once, in ranges of (conversation, turn, role, beginning of the text), so a conversation of any length lies in several tasks. Each range is cut
   into segments of at most ``SEGMENT`` symbols of one conversation; a run of rows that must go is one symbol with a count.
3. Signatures of segments are made distinct, sorted from their ends, and walked: consecutive ones share the nodes of their common suffix.
4. What follows a segment counts by the difference of its costs between grammar states, of which there are a few dozen kinds (``KINDS``). A conversation of
   one segment needs only the kind "nothing follows". For longer ones each signature is a small table, kind on the right to kind on the left and state to state; tables
   are combined ``FAN`` at a time up to one per conversation and the kinds and states dealt back down.
5. Each segment applies its audit to its rows. Digests of conversations of several segments stream through one task in order, since SHA-256 is
   sequential; that task holds one segment at a time.

Of equally cheap audits the ASCII-least comes: the edits possible at a place have different initials, so the choice is local.

Nulls count as one space, in the names that decide the damage too; a null id is one conversation. Null turns come first; rows of one turn go by role, then text. Roles
count by their first character; any but s, u, a (none at all included) fits nowhere. Repeated rows are duplicates of the first. Conversations
without a row left have zeros, an empty audit and the digest of nothing. Texts of any length are read whole. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_tables, python_ready, read_table, release_caches, stored_table

SEGMENT, FAN = 64, 64
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
#: Grammar states: 0 nothing yet, 1 after s, 2 after u, 3 after a; a conversation may end in 0 and 3.
START, ENDS = 0, (0, 3)
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The user or assistant row that fits at a state, which edits put there.
FITS = ("u", "u", "a", "u")
ROLES = {"u": "user", "a": "assistant"}
#: x must go; other rows have the initial of their role, in capitals if truncated, o if it fits nowhere.
SYMBOLS = "xsuaoSUAO"


class Node:
    """One suffix: per grammar state the cost to go, the cost inside the segment, the state behind it, and the audit."""

    __slots__ = ("togo", "paid", "left", "audit")

    def __init__(self, togo, paid, left, audit):
        self.togo, self.paid, self.left, self.audit = togo, paid, left, audit


def _with_inserts(options: list[list[tuple]]) -> Node:
    """The best of each state's options (cost, edit, cost inside, state behind, audit), inserts added."""
    best = [min(o, default=None) for o in options]
    for _ in range(4):  # no more than three inserts in a row are of use
        for s, fits in enumerate(FITS):
            then = best[NEXT[s][fits]]
            if then is not None:
                option = (INSERT + then[0], "I", INSERT + then[2], then[3], "I" + then[4])
                if best[s] is None or option[:2] <= best[s][:2]:
                    best[s] = option
    return Node(*zip(*[(b[0], b[2], b[3], b[4]) for b in best]))


def before(symbol: str, rest: Node) -> Node:
    """The node of ``symbol`` followed by ``rest``."""
    initial, more = symbol.lower(), TRUNCATED if symbol.isupper() else 0
    options = []
    for s in range(4):
        ways = [(DELETE, "D", s)]
        if symbol != "x":
            if initial in NEXT[s]:
                ways.append((more, "K", NEXT[s][initial]))
            ways.append((REROLE + more, "R", NEXT[s][FITS[s]]))
        options.append([(c + rest.togo[t], e, c + rest.paid[t], rest.left[t], e + rest.audit[t]) for c, e, t in ways])
    return _with_inserts(options)


#: Behind the last row of a conversation.
LAST = _with_inserts([[(0, "", 0, s, "")] if s in ENDS else [] for s in range(4)])


def _kind(togo: tuple) -> tuple:
    return tuple(c - min(togo) for c in togo)


def _kinds() -> list[tuple]:
    """What can follow: costs to go relative to the least, all that symbols lead to from the end."""
    found, queue = [], [LAST]
    while queue:
        rest = queue.pop()
        for symbol in SYMBOLS:
            node = before(symbol, rest)
            kind = _kind(node.togo)
            if kind not in found:
                found.append(kind)
                queue.append(Node(kind, (0,) * 4, range(4), ("",) * 4))
    return found


#: Kind 0: nothing follows.
KINDS = [_kind(LAST.togo), *sorted(_kinds())]
_NUMBER = {kind: k for k, kind in enumerate(KINDS) if k}


def ending(kind: int) -> Node:
    """The node behind the last symbol of a segment."""
    return Node(KINDS[kind], (0,) * 4, tuple(range(4)), ("",) * 4) if kind else LAST


def walk(batches):
    """From (kind, signature) sorted by kind and reversed signature: kind on the left, costs, states behind and audits, each by the state before it.

    ``path`` holds the nodes of the last signature's suffixes; what the next one shares with it is not computed again.
    """
    path, last, of = [], "", None
    for batch in batches:
        rows = []
        for kind, signature in zip(batch.column("kind").to_pylist(), batch.column("signature").to_pylist()):
            back = signature[::-1]
            if kind != of:
                path, last, of = [ending(kind)], "", kind
            same = 0
            while same < min(len(back), len(last)) and back[same] == last[same]:
                same += 1
            del path[same + 1:]
            for symbol in back[same:]:
                path.append(before(symbol, path[-1]))
            last, node = back, path[-1]
            rows.append((kind, signature, _NUMBER[_kind(node.togo)], list(node.paid), list(node.left), list(node.audit)))
        names = ["kind", "signature", "onward", "costs", "states", "audits"]
        kinds = [pa.int32(), pa.string(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 6, kinds)], names)


WALKED = "kind int, signature string, onward int, costs array<bigint>, states array<int>, audits array<string>"


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: the rows after the damage that their names decide, equal ones counted."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select("conv_id", F.col("turn").cast("long"), space("role").alias("role"), space("text").alias("text"),
                       (F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20).alias("how"))
    how = F.col("how")
    text = F.when(how == 1, "").when(how == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.filter("how != 0").select(
        "conv_id", "turn", F.when(how == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(how == 3, 2).otherwise(1).cast("long").alias("copies"))
    return counted(rows)


def counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))


def _same(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join on columns of which nulls are equal; they come from the left side."""
    on = [left[n].eqNullSafe(right[f"{n}__"]) for n in names]
    right_side = right
    return left.join(right_side, on, how).drop(*[f"{n}__" for n in names])


def _side(frame: DataFrame, names: list[str]) -> DataFrame:
    return frame.withColumnsRenamed({n: f"{n}__" for n in names})


def judged(rows: DataFrame) -> DataFrame:
    """The counted rows with their first fault (blank, duplicate, truncated or null, of the first copy) and symbol."""
    words = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    rows = rows.withColumn("blank", ~words).withColumn("said", F.when(words, F.sha2("text", 256)))
    names = ["conv_id", "role", "said"]
    firsts = rows.filter("NOT blank").groupBy(*names).agg(F.max(F.col("turn").isNull()).alias("early"), F.min("turn").alias("least"))
    rows = _same(rows, _side(firsts, names), names, "left")
    again = F.coalesce(F.when(F.col("early"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("least")), F.lit(False))
    fault = F.when(F.col("blank"), "blank").when(again, "duplicate").when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated")
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    rows = rows.withColumn("fault", fault).withColumn("initial", initial)
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial"))
    return rows.select("conv_id", "turn", "role", "text", "copies", "fault", "initial", symbol.alias("symbol"))


def _fault_counts(rows: DataFrame) -> DataFrame:
    """gaps, blank, duplicate, truncated of every conversation; turns are counted once each before."""
    count = lambda fault, what: F.sum(F.when(F.col("fault") == fault, what).otherwise(0)).alias(fault)
    copies = F.when(F.col("fault") == "duplicate", F.col("copies")).when(F.col("fault") == "blank", 0).otherwise(F.col("copies") - 1)
    turns = rows.groupBy("conv_id", "turn").agg(count("blank", F.col("copies")), F.sum(copies).alias("duplicate"), count("truncated", F.lit(1)))
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
    return turns.groupBy("conv_id").agg(gaps.alias("gaps"), *[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated")])


def _illegal(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


def _cut(size: int):
    """From rows in order: segments of at most ``size`` symbols of one conversation, numbered from 0 in each range."""
    names = ["part", "seg", "signature", "runs", "roles", "texts", "first", "last", "illegal"]
    kinds = [pa.int32(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()), pa.string(), pa.string(), pa.int64()]

    def run(batches):
        release_caches()
        part, conv, seg, now, of = TaskContext.get().partitionId(), None, 0, None, None

        def out():
            signature, runs, roles, texts, first, last, illegal = now
            row = [part, seg, "".join(signature), runs, roles, texts, first, last, illegal]
            return pa.RecordBatch.from_arrays([of, *[pa.array([v], k) for v, k in zip(row, kinds)]], ["conv_id", *names])

        def merged(done):
            return [pa.Table.from_batches(done).combine_chunks().to_batches()[0]] if done else []

        done, held = [], 0
        for batch in batches:
            convs, columns = batch.column("conv_id"), [batch.column(c).to_pylist() for c in ("symbol", "role", "text", "copies", "initial")]
            ids = convs.to_pylist()
            for k, (symbol, role, text, copies, initial) in enumerate(zip(*columns)):
                fresh = now is None or ids[k] != conv
                # a symbol may bring a run of copies with it; a run goes on in the segment it began in
                if fresh or len(now[0]) >= size and not (symbol == "x" == now[0][-1]):
                    if now is not None:
                        done.append(out())
                        held += 1
                    seg = 0 if fresh else seg + 1
                    conv, of = ids[k], pa.concat_arrays([convs.slice(k, 1)])
                    now = [[], [], [], [], initial, "", 0]
                if now[0]:
                    now[6] += _illegal(now[5], initial)
                now[6] += copies - 1
                now[5] = initial
                if symbol != "x":
                    now[0].append(symbol)
                    now[2].append(role)
                    now[3].append(text)
                    copies -= 1
                if copies:
                    if now[0] and now[0][-1] == "x":
                        now[1][-1] += copies
                    else:
                        now[0].append("x")
                        now[1].append(copies)
                if held >= 256:
                    yield from merged(done)
                    done, held = [], 0
        if now is not None:
            done.append(out())
        yield from merged(done)
    return run


def _segments(rows: DataFrame, size: int, kind: T.DataType) -> DataFrame:
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role")]
    rows = rows.repartitionByRange(*order, F.substring("text", 1, 32)).sortWithinPartitions(*order, "text")
    schema = T.StructType([T.StructField("conv_id", kind), *T.StructType.fromDDL(
        "part int, seg bigint, signature string, runs array<bigint>, roles array<string>, texts array<string>, first string, last string, illegal bigint")])
    return rows.select("conv_id", "symbol", "role", "text", "copies", "initial").mapInArrow(_cut(size), schema)


def _walked(signatures: DataFrame) -> DataFrame:
    """Each distinct (kind, signature) through the shared automaton; equal suffixes lie side by side in a range."""
    back = F.reverse("signature")
    return signatures.distinct().repartitionByRange("kind", back).sortWithinPartitions("kind", back).mapInArrow(walk, WALKED)


def _combined(key, table):
    """Neighbouring pieces of a conversation as one: for every kind on the right the kind on the left and the state behind each state."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["seg"]))
    onward, states = rows[-1]["onward"], rows[-1]["states"]
    illegal, last = rows[0]["illegal"], rows[0]["last"]
    for row in rows[1:]:
        illegal, last = illegal + row["illegal"] + _illegal(last, row["first"]), row["last"]
    for row in rows[-2::-1]:
        states = [[after[s] for s in row["states"][k]] for k, after in zip(onward, states)]
        onward = [row["onward"][k] for k in onward]
    return pa.table({
        "conv_id": table.column("conv_id").slice(0, 1), "part": pa.array([rows[0]["part_up"]], pa.int32()), "seg": pa.array([rows[0]["seg_up"]], pa.int64()),
        "first": [rows[0]["first"]], "last": [last], "illegal": pa.array([illegal], pa.int64()),
        "onward": pa.array([onward], pa.list_(pa.int32())), "states": pa.array([states], pa.list_(pa.list_(pa.int32())))})


def _dealt(key, table):
    """The kind on the right and the state on the left of every piece, from those of the whole."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["seg"]))
    kind, kinds = rows[0]["kind"], []
    for row in reversed(rows):
        kinds.append(kind)
        kind = row["onward"][kind]
    state, states = rows[0]["state"], []
    for row, kind in zip(rows, reversed(kinds)):
        states.append(state)
        state = row["states"][kind][state]
    return pa.table({
        "conv_id": table.column("conv_id"), "part": pa.array([r["part"] for r in rows], pa.int32()), "seg": pa.array([r["seg"] for r in rows], pa.int64()),
        "kind": pa.array(kinds[::-1], pa.int32()), "state": pa.array(states, pa.int32())})


def _chained(segments: DataFrame, kind: T.DataType, fan: int, folders: list[str]) -> tuple[DataFrame, DataFrame]:
    """(kind, state of every segment; illegal neighbours of every conversation) of conversations of several segments."""
    signatures = segments.select("signature", F.explode(F.sequence(F.lit(0), F.lit(len(KINDS) - 1))).alias("kind"))
    tables = _walked(signatures.select("kind", "signature")).groupBy("signature").agg(
        F.array_sort(F.collect_list(F.struct("kind", "onward", "states"))).alias("t"))  # one row per kind
    tables = tables.select("signature", F.col("t.onward").alias("onward"), F.col("t.states").alias("states"))
    level = segments.join(tables, "signature").select("conv_id", "part", "seg", "first", "last", "illegal", "onward", "states")
    levels = [stored_table(level, "level", folders)]
    piece = T.StructType([T.StructField("conv_id", kind), *T.StructType.fromDDL(
        "part int, seg bigint, first string, last string, illegal bigint, onward array<int>, states array<array<int>>")])
    given = T.StructType([T.StructField("conv_id", kind), *T.StructType.fromDDL("part int, seg bigint, kind int, state int")])
    ups: list[tuple[Column, Column]] = []
    while True:
        seg, part, low = levels[-1].agg(F.max("seg"), F.max("part"), F.count(F.lit(1))).first()
        if not low or not seg and not part:
            break
        up = (F.col("part"), (F.col("seg") / fan).cast("long")) if seg else ((F.col("part") / fan).cast("int"), F.col("seg"))
        ups.append(up)
        grouped = levels[-1].withColumns({"part_up": up[0], "seg_up": up[1]}).groupBy("conv_id", "part_up", "seg_up")
        levels.append(stored_table(grouped.applyInArrow(_combined, piece), "level", folders))
    illegal = levels[-1].select("conv_id", "illegal")
    places = levels[-1].select("conv_id", "part", "seg", F.lit(0).alias("kind"), F.lit(START).alias("state"))
    names = ["conv_id", "part_up", "seg_up"]
    for level, up in zip(levels[-2::-1], ups[::-1]):
        above = _side(places.withColumnsRenamed({"part": "part_up", "seg": "seg_up"}), names)
        below = _same(level.withColumns({"part_up": up[0], "seg_up": up[1]}), above, names)
        places = stored_table(below.groupBy(*names).applyInArrow(_dealt, given), "places", folders)
    return places, illegal


def _applied(batches):
    """Segments with their audit and state: the audit with runs written out, and the repaired rows."""
    for batch in batches:
        audits, repaired = [], []
        columns = [batch.column(c).to_pylist() for c in ("audit", "state", "signature", "runs", "roles", "texts")]
        for audit, state, signature, runs, roles, texts in zip(*columns):
            symbols, runs, rows = iter(signature), iter(runs), iter(zip(roles, texts))
            out, lines = [], []
            for edit in audit:
                out.append(edit)
                if edit == "I":
                    lines.append(ROLES[FITS[state]] + ":")
                    state = NEXT[state][FITS[state]]
                    continue
                symbol = next(symbols)
                if symbol == "x":
                    out[-1] = "D" * next(runs)
                    continue
                role, text = next(rows)
                if edit == "K":
                    lines.append(f"{role}:{text}")
                    state = NEXT[state][symbol.lower()]
                elif edit == "R":
                    lines.append(f"{ROLES[FITS[state]]}:{text}")
                    state = NEXT[state][FITS[state]]
            audits.append("".join(out))
            repaired.append("\n".join(lines) if lines else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("conv_id", "part", "seg", "cost")] + [pa.array(audits, pa.string()), pa.array(repaired, pa.string())],
            ["conv_id", "part", "seg", "cost", "audit", "repaired"])


def _digests(batches):
    """From segments in order: the digest of every conversation's repaired rows, one segment at a time."""
    conv, of, digest, some = None, None, None, False
    row = lambda: pa.RecordBatch.from_arrays([of, pa.array([digest.hexdigest()])], ["conv_id", "repaired_sha256"])
    for batch in batches:
        convs = batch.column("conv_id")
        for k, (now, text) in enumerate(zip(convs.to_pylist(), batch.column("repaired").to_pylist())):
            if digest is None or now != conv:
                if digest is not None:
                    yield row()
                conv, of, digest, some = now, pa.concat_arrays([convs.slice(k, 1)]), hashlib.sha256(), False
            if text is not None:
                digest.update((b"\n" if some else b"") + text.encode())
                some = True
    if digest is not None:
        yield row()


def repaired(rows: DataFrame, segment: int = SEGMENT, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """(repaired segments: conv_id, part, seg, cost, audit, repaired; conversations: gaps, faults, illegal, cost, audit, repaired_sha256).

    ``rows`` has conv_id, turn, role, text and copies, equal rows counted. Both tables are stored; steps on the way are dropped.
    """
    spark, folders, kind = rows.sparkSession, [], rows.schema["conv_id"].dataType
    python_ready(spark)
    rows = stored_table(judged(stored_table(rows, "rows", folders)), "judged", folders)
    segments = stored_table(_segments(rows, segment, kind), "segments", folders)
    number = segments.groupBy("conv_id").agg(F.count(F.lit(1)).alias("pieces"))
    several = _same(segments, _side(number.filter("pieces > 1").select("conv_id"), ["conv_id"]), ["conv_id"], "left_semi")
    places, crossing = _chained(several.select("conv_id", "part", "seg", "signature", "first", "last", "illegal"), kind, fan, folders)
    names = ["conv_id", "part", "seg"]
    long = _same(several, _side(places, names), names)
    short = _same(segments, _side(number.filter("pieces = 1").select("conv_id"), ["conv_id"]), ["conv_id"], "left_semi")
    placed = long.unionByName(short.withColumns({"kind": F.lit(0), "state": F.lit(START)}))
    walked = stored_table(_walked(placed.select("kind", "signature")), "walked", folders)
    # a run counts as one symbol in the signature: its other rows are deleted too
    more = DELETE * F.aggregate("runs", F.lit(0).cast("long"), lambda s, x: s + x - 1)
    applied = placed.join(walked.select("kind", "signature", "costs", "audits"), ["kind", "signature"]).select(
        *names, "state", "signature", "runs", "roles", "texts", F.get("audits", "state").alias("audit"), (F.get("costs", "state") + more).alias("cost"))
    pieces = T.StructType([T.StructField("conv_id", kind), *T.StructType.fromDDL("part int, seg bigint, cost bigint, audit string, repaired string")])
    done = stored_table(applied.mapInArrow(_applied, pieces), "repaired")
    single = _same(done, _side(number, ["conv_id"]), ["conv_id"])
    single, many = single.filter("pieces = 1"), single.filter("pieces > 1")
    digests = many.select(*names, "repaired").repartition("conv_id").sortWithinPartitions(*names)
    digests = digests.mapInArrow(_digests, T.StructType([T.StructField("conv_id", kind), T.StructField("repaired_sha256", T.StringType())]))
    whole = many.groupBy("conv_id").agg(F.sum("cost").alias("cost"), F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("part", "seg", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    whole = _same(_same(whole, _side(digests, ["conv_id"]), ["conv_id"]), _side(crossing, ["conv_id"]), ["conv_id"])
    lone = _same(single.select(*names, "cost", "audit", F.sha2(F.coalesce("repaired", F.lit("")), 256).alias("repaired_sha256")),
                 _side(segments.select(*names, "illegal"), names), names)
    columns = ["conv_id", "cost", "audit", "repaired_sha256", "illegal"]
    every = lone.select(*columns).union(whole.select(*columns))
    out = stored_table(_same(_fault_counts(rows), _side(every, ["conv_id"]), ["conv_id"]), "conversations")
    drop_tables(spark, folders)
    return done, out


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cost, audit and digest of the cheapest repair of every conversation after the damage."""
    rows = read_table(spark, sf_dir, "conversations")
    _, found = repaired(damaged(rows))
    names = rows.select("conv_id").distinct()
    out = _same(names, _side(found, ["conv_id"]), ["conv_id"], "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def _steps() -> str:
    """Check SQL of one row more: best option per grammar state (k: cost and rank of the edit, a: audit, l: repaired rows), before inserts."""
    def option(cost: str, rank: int, edit: str, after: int, line: str) -> str:
        return f"{{'k': 4 * (v{after}.k // 4 + {cost}) + {rank}, 'a': '{edit}' || v{after}.a, 'l': {f'list_prepend({line}, v{after}.l)' if line else f'v{after}.l'}}}"

    made = []
    for s in range(4):
        kept = " ".join(f"WHEN NOT gone AND ini = '{c}' THEN {option('more', 2, 'K', t, 'said')}" for c, t in NEXT[s].items())
        role = ROLES[FITS[s]]
        again = option(f"{REROLE} + more", 3, "R", NEXT[s][FITS[s]], f"'{role}:' || text")
        made.append(f"list_min([{option(str(DELETE), 0, 'D', s, '')}, CASE {kept} END, CASE WHEN NOT gone THEN {again} END]) AS b{s}")
    return ", ".join(made)


def _insert(s: int, own: str, after: str) -> str:
    return f"list_min([{own}, {{'k': 4 * ({after}.k // 4 + {INSERT}) + 1, 'a': 'I' || {after}.a, 'l': list_prepend('{ROLES[FITS[s]]}:', {after}.l)}}])"


ORACLE = rf"""
WITH RECURSIVE crc AS (SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) AS c FROM range(256) r(i))),
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
judged AS (SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(string_split(name, ''), lambda x: ord(x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS how FROM named, crc),
damaged AS (SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role, CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE how WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM judged),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
faults AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' END AS fault, substr(role, 1, 1) AS ini, lead(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS following FROM placed),
ready AS MATERIALIZED (SELECT conv_id, i, ini, text, role || ':' || text AS said, coalesce(fault IN ('blank', 'duplicate'), false) AS gone,
    CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END AS more FROM faults),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (following IS NOT NULL AND ini || following NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM faults GROUP BY conv_id),
walk AS (
    SELECT conv_id, n + 1 AS i, {{'k': 0::BIGINT, 'a': '', 'l': []::VARCHAR[]}} AS v0, {{'k': {2 * INSERT * 4}::BIGINT, 'a': 'II', 'l': ['user:', 'assistant:']}} AS v1,
        {{'k': {INSERT * 4}::BIGINT, 'a': 'I', 'l': ['assistant:']}} AS v2, {{'k': 0::BIGINT, 'a': '', 'l': []::VARCHAR[]}} AS v3 FROM counts
    UNION ALL
    SELECT conv_id, i, {_insert(0, 'b0', 'w2')}, {_insert(1, 'b1', 'w2')}, w2, w3 FROM (
        SELECT *, {_insert(2, 'b2', 'b3')} AS w2, {_insert(3, 'b3', 'b2')} AS w3 FROM (
            SELECT walk.conv_id, ready.i, {_steps()} FROM walk JOIN ready ON ready.conv_id IS NOT DISTINCT FROM walk.conv_id AND ready.i = walk.i - 1))
), ended AS (SELECT conv_id, v0.k // 4 AS cost, v0.a AS audit, sha256(array_to_string(v0.l, chr(10))) AS repaired_sha256 FROM walk WHERE i = 1)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
    coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM o.conv_id
"""
