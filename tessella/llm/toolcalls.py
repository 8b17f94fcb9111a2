"""Tool-call linking: calls and results joined by identifier, checked, ordered, written canonically.

Messages are rows ``conv_id, turn, role, text``.  A call message is a JSON object with
``tool_calls``, a list of ``{"id", "name", "arguments", "depends_on"}``; a result message has role
``tool`` and a JSON object with ``tool_call_id`` and ``content``.  Other messages are text and give
no events.

* An id may be used again: its calls are numbered in transcript order, a result belongs to the
  latest call of its id at or before it, and a dependency means the latest call of that id before,
  or else the first after.  Calls and results then meet in a hash join on (conv_id, call id,
  number).  Every call and every result is in one row of the output.
* Arguments are checked against the schema of the tool's name (type, required, properties, items,
  enum, minLength, maxLength, additionalProperties), and all that is wrong is listed.
* ``position`` is a call's place in a topological order of its conversation: by ``ready``, the
  latest transcript place among the call and all it depends on, directly or not; then by the steps
  to the call at that place; then by its own place.  Where no dependency points forward that is
  the transcript's order.  Only conversations with a forward dependency are solved, each in one
  task while it has at most ``MOST_EDGES`` calls and dependencies, and level by level over the
  cluster beyond that.  Calls on or behind a cycle are ``cyclic`` and have no position.
* Canonical JSON: sorted keys, no blanks, no escapes beyond those JSON needs.

Counts along a conversation are taken in blocks of turns, so a conversation or an id with many of
all rows is no single task's work.

Defined cases: null texts, texts that aren't JSON objects (NaN, infinite numbers and nesting
beyond Python's limit included) and malformed entries give no events; a name that is no string is
no name; a call without an id is named after its turn and place; arguments given as a JSON string
are parsed; lone surrogates become U+FFFD in names and ids and stay escaped in JSON; equal
messages are one, with their number in ``copies``; a null conv_id is one more conversation, a null
turn comes before all others; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.workers import arrow_map, ship
from tessella.llm.shared import cut, earlier_in_group

EVENT = "key binary, conv_id {kind}, turn long, place int, kind string, call_id string, name string, arguments string, depends_on array<string>, errors string, content string"
TYPES = {"string": str, "object": dict, "array": list, "boolean": bool, "null": type(None)}
#: Most calls and dependencies of a conversation that one task orders.
MOST_EDGES = 100_000
_LONE = re.compile("[\ud800-\udfff]")


def canonical(value: object) -> str:
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return _LONE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def _plain(text: str) -> str:
    return _LONE.sub("�", text)


def _is_number(value: object) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def _of_type(value: object, kind: str) -> bool:
    if kind == "number":
        return _is_number(value)
    if kind == "integer":
        return _is_number(value) and (isinstance(value, int) or value.is_integer())
    return isinstance(value, TYPES.get(kind, object))


def problems(value: object, schema: dict, where: str = "$") -> list[str]:
    """What is wrong with ``value``, by the part of JSON Schema named above."""
    if "type" in schema and not _of_type(value, schema["type"]):
        return [f"{where}: not {schema['type']}"]
    same = lambda x: x == value and isinstance(x, bool) == isinstance(value, bool)
    found = [f"{where}: not allowed"] if "enum" in schema and not any(map(same, schema["enum"])) else []
    if isinstance(value, str):
        found += [f"{where}: too short"] if len(value) < schema.get("minLength", 0) else []
        found += [f"{where}: too long"] if len(value) > schema.get("maxLength", len(value)) else []
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{where}.{k}: missing" for k in schema.get("required", []) if k not in value]
        found += [f"{where}.{k}: unknown" for k in sorted(value) if k not in known and schema.get("additionalProperties") is False]
        for k in sorted(known.keys() & value.keys()):
            found += problems(value[k], known[k], f"{where}.{k}")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            found += problems(x, schema["items"], f"{where}[{i}]")
    return found


def _finite(text: str) -> float:
    value = float(text)
    if math.isinf(value):
        raise ValueError(f"{text} is out of range")
    return value


def _no_number(text: str) -> None:
    raise ValueError(f"{text} is not JSON")


def _object(text: str | None) -> dict | None:
    """The JSON object that ``text`` is, if it is one."""
    if not text or not text.lstrip().startswith("{"):
        return None
    try:
        value = json.loads(text, parse_float=_finite, parse_constant=_no_number)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _call(call: dict, turn: int | None, place: int, schemas: dict) -> tuple:
    name, arguments = call.get("name"), call.get("arguments")
    name = _plain(name) if isinstance(name, str) else None
    if isinstance(arguments, str):
        parsed = _object(arguments)
        arguments = arguments if parsed is None else parsed
    wrong = problems(arguments, schemas[name]) if name in schemas else ["$: unknown tool"]
    ids = call.get("depends_on")
    depends = [_plain(x) for x in ids if isinstance(x, str)] if isinstance(ids, list) else []
    call_id = _plain(call["id"]) if isinstance(call.get("id"), str) else f"{turn}:{place}"
    return place, "call", call_id, name, canonical(arguments), depends, _plain("; ".join(wrong)), None


def _events(role: str | None, text: str | None, turn: int | None, schemas: dict) -> Iterator[tuple]:
    message = _object(text)
    if message is None:
        return
    try:
        if role == "tool" and isinstance(message.get("tool_call_id"), str):
            yield 0, "result", _plain(message["tool_call_id"]), None, None, None, None, canonical(message.get("content"))
        calls = message.get("tool_calls")
        for place, call in enumerate(calls if isinstance(calls, list) else []):
            if isinstance(call, dict):
                yield _call(call, turn, place, schemas)
    except RecursionError:  # nested deeper than json can write
        return


def events(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call or result found in the messages; ``key`` names message, kind and place."""
    kind = messages.schema["conv_id"].dataType.simpleString()
    names = ["turn", "place", "kind", "call_id", "name", "arguments", "depends_on", "errors", "content"]
    types = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string()]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, index, keys = [], [], []
            for i, (conv, turn, role, text) in enumerate(zip(*(batch.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text")), strict=True)):
                message = None
                for event in _events(role, text, turn, schemas):
                    message = message or hashlib.blake2b(repr((conv, turn, role, text)).encode(errors="replace"), digest_size=16).digest()
                    keys.append(message + b"%s%d" % (event[1][:1].encode(), event[0]))
                    rows.append((turn, *event))
                    index.append(i)
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), batch.column("conv_id").take(pa.array(index, pa.int32())), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], ["key", "conv_id", *names])

    rows = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    return arrow_map(rows, found, EVENT.format(kind=kind))


def numbered(found: DataFrame) -> DataFrame:
    """``conv_id, call_id, turn, place, seq, key, before``: events and dependencies, and the calls of the id before.

    ``seq`` is 0 for a dependency (``key`` is its call's), 1 for a call, 2 for a result, which is
    also their order at the same place.
    """
    own = found.select("conv_id", "call_id", "turn", "place", F.when(F.col("kind") == "call", 1).otherwise(2).alias("seq"), "key")
    wanted = found.where("kind = 'call'").select("conv_id", F.explode(F.array_distinct("depends_on")).alias("call_id"), "turn", "place", F.lit(0).alias("seq"), "key")
    return earlier_in_group(own.union(wanted), ["conv_id", "call_id"], "turn", ["turn", "place", "seq", "key"], F.when(F.col("seq") == 1, 1).otherwise(0), "before")


def _same(conv: str, call: str, number: Column | None = None) -> Column:
    met = F.col("conv_id").eqNullSafe(F.col(conv)) & (F.col("call_id") == F.col(call))
    return met if number is None else met & number


SOLVED = "key binary, ready_turn long, ready_place int, hops int, cyclic boolean"


def _in_order(at: dict, wants: dict) -> Iterator[tuple]:
    """``key, ready, hops`` of the calls at places ``at``, dependencies (``wants``) first; none on or behind a cycle."""
    left = {k: len(wants.get(k, ())) for k in at}
    users: dict = {}
    for k, deps in wants.items():
        for d in deps:
            users.setdefault(d, []).append(k)
    found: dict = {}
    free = [k for k, n in left.items() if not n]
    while free:
        k = free.pop()
        best = max((found[d] for d in wants.get(k, ())), default=(at[k], -1))
        found[k] = (best[0], best[1] + 1) if best[0] >= at[k] else (at[k], 0)
        yield k, *found[k]
        for u in users.get(k, ()):
            left[u] -= 1
            if not left[u]:
                free.append(u)


def _solve(table: pa.Table) -> pa.Table:
    """One conversation: rows with ``dep`` are dependencies, the others calls."""
    at, wants = {}, {}
    for key, turn, place, dep in zip(*(table.column(n).to_pylist() for n in ("key", "turn", "place", "dep")), strict=True):
        if dep is None:
            at[key] = (turn is not None, turn or 0, place)
        else:
            wants.setdefault(key, []).append(dep)
    rows = [(k, ready[1] if ready[0] else None, ready[2], hops, False) for k, ready, hops in _in_order(at, wants)]
    rows += [(k, None, None, None, True) for k in at.keys() - {r[0] for r in rows}]
    types = [pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[c.split(" ")[0] for c in SOLVED.split(", ")])


def _solve_by_levels(rows: DataFrame) -> DataFrame:
    """The same for conversations of any size: a join a level, each written to the shared folder."""
    none = F.lit(None).cast("struct<turn:bigint,place:int>")
    own = F.struct("turn", "place")
    edges = rows.where("dep is not null").select("key", "dep")
    wants = edges.groupBy("key").agg(F.count("*").alias("left"))
    nodes = rows.where("dep is null").select("key", own.alias("at")).join(wants, "key", "left").select("key", "at", F.coalesce("left", F.lit(0)).alias("left"), F.struct(none.alias("ready"), F.lit(-1).alias("hops")).alias("best"))
    done = None
    while True:
        nodes = cut(nodes, "pending")
        later = F.col("best.hops") >= 0
        follows = later & (F.col("best.ready") >= F.col("at"))
        free = nodes.where("left = 0").select("key", F.when(follows, F.col("best.ready")).otherwise(F.col("at")).alias("ready"), F.when(follows, F.col("best.hops") + 1).otherwise(0).alias("hops"))
        if not free.take(1):
            break
        done = free if done is None else done.union(free)
        told = edges.join(free.select(F.col("key").alias("dep"), F.struct("ready", "hops").alias("got")), "dep").groupBy("key").agg(F.count("*").alias("n"), F.max("got").alias("got"))
        rest = nodes.where("left > 0").join(told, "key", "left")
        better = F.col("got").isNotNull() & ((F.col("best.hops") < 0) | (F.col("got") > F.col("best")))
        nodes = rest.select("key", "at", (F.col("left") - F.coalesce("n", F.lit(0))).alias("left"), F.when(better, F.col("got")).otherwise(F.col("best")).alias("best"))
    stuck = nodes.select("key", F.lit(None).cast("long").alias("ready_turn"), F.lit(None).cast("int").alias("ready_place"), F.lit(None).cast("int").alias("hops"), F.lit(True).alias("cyclic"))
    if done is None:
        return stuck
    return done.select("key", "ready.turn", "ready.place", F.col("hops").cast("int"), F.lit(False)).union(stuck).toDF(*(c.split(" ")[0] for c in SOLVED.split(", ")))


def positions(at: DataFrame) -> DataFrame:
    """``key, position, cyclic`` of every call, from :func:`numbered`'s written rows."""
    calls = at.where("seq = 1").select("conv_id", "call_id", "turn", "place", "key", (F.col("before") + 1).alias("number"))
    wanted = at.where("seq = 0")
    target = calls.select(F.col("conv_id").alias("_conv"), F.col("call_id").alias("_call"), F.col("number").alias("_number"), F.col("key").alias("dep"))
    tangled = wanted.where("before = 0").join(target.where("_number = 1"), _same("_conv", "_call")).select(F.col("conv_id").alias("_tangled")).distinct()
    tangled = cut(tangled, "tangled")
    inside = F.col("conv_id").eqNullSafe(F.col("_tangled"))
    edges = wanted.join(tangled, inside, "left_semi").join(target, _same("_conv", "_call", F.greatest(F.col("before"), F.lit(1)) == F.col("_number")))
    rows = calls.join(tangled, inside, "left_semi").select("conv_id", "key", "turn", "place", F.lit(None).cast("binary").alias("dep"))
    rows = cut(rows.unionByName(edges.select("conv_id", "key", "turn", "place", "dep")), "dependencies")
    large = cut(rows.groupBy("conv_id").count().where(F.col("count") > MOST_EDGES).select(F.col("conv_id").alias("_tangled")), "large")
    ship(at.sparkSession)
    solved = rows.join(large, inside, "left_anti").groupBy("conv_id").applyInArrow(_solve, SOLVED)
    if large.take(1):
        solved = solved.union(_solve_by_levels(rows.join(large, inside, "left_semi")))
    solved = solved.withColumnRenamed("key", "_key")
    of = lambda name, plain: F.when(F.col("_key").isNotNull(), F.col(name)).otherwise(plain)
    placed = calls.join(solved, F.col("key") == F.col("_key"), "left").select("conv_id", "key", "turn", "place", of("ready_turn", F.col("turn")).alias("ready_turn"), of("ready_place", F.col("place")).alias("ready_place"), F.coalesce("hops", F.lit(0)).alias("hops"), F.coalesce("cyclic", F.lit(False)).alias("cyclic"))
    placed = cut(placed, "placed")
    ranked = earlier_in_group(placed.where("not cyclic"), ["conv_id"], "ready_turn", ["ready_turn", "ready_place", "hops", "turn", "place", "key"], F.lit(1), "position")
    return ranked.select("key", "position", "cyclic").union(placed.where("cyclic").select("key", F.lit(None).cast("long"), "cyclic"))


def links(heads: DataFrame) -> DataFrame:
    """What each event is linked to: ``key, occurrence, status, position, cyclic, result_turn, n_results, copies, target``.

    ``target`` is the call that a result is the first one of.  Nothing of the events' content takes part.
    """
    at = cut(numbered(heads), "occurrences")
    copies = heads.select(F.col("key").alias("_copied"), "copies")
    calls = at.where("seq = 1").select("key", "conv_id", "call_id", (F.col("before") + 1).alias("occurrence")).join(positions(at), "key")
    results = at.where("seq = 2").join(copies, F.col("key") == F.col("_copied")).select("key", "conv_id", "call_id", "turn", "place", F.col("before").alias("occurrence"), "copies")
    first = results.where("occurrence > 0").groupBy("conv_id", "call_id", "occurrence").agg(F.min(F.struct("turn", "place", "key")).alias("first"), F.sum("copies").alias("n_results"))
    first = first.select(F.col("conv_id").alias("_conv"), F.col("call_id").alias("_call"), F.col("occurrence").alias("_number"), "first", "n_results")
    met = calls.join(first, _same("_conv", "_call", F.col("occurrence") == F.col("_number")), "left").join(copies, F.col("key") == F.col("_copied"))
    of_calls = met.select("key", "occurrence", F.when(F.col("first").isNull(), "unanswered").otherwise("linked").alias("status"), "position", "cyclic", F.col("first.turn").alias("result_turn"), F.coalesce("n_results", F.lit(0)).alias("n_results"), "copies", F.col("first.key").alias("target"))
    of_calls = cut(of_calls, "call-links")
    answers = of_calls.where("target is not null").select(F.col("target").alias("_answer"), F.col("key").alias("_target"))
    named = at.where("seq = 1 and before = 0").select(F.col("conv_id").alias("_conv"), F.col("call_id").alias("_call"))
    status = F.when(F.col("_target").isNotNull(), "answer").when(F.col("_call").isNull(), "orphan").when(F.col("occurrence") == 0, "early").otherwise("repeated")
    placed = results.join(answers, F.col("key") == F.col("_answer"), "left").join(named, _same("_conv", "_call"), "left")
    of_results = placed.select("key", "occurrence", status.alias("status"), F.lit(None).cast("long").alias("position"), F.lit(False).alias("cyclic"), F.col("turn").alias("result_turn"), F.lit(0).cast("long").alias("n_results"), "copies", F.col("_target").alias("target"))
    return cut(of_calls.withColumn("target", F.lit(None).cast("binary")).unionByName(of_results), "links")


def link(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call, and one per result that is no call's first.

    ``status`` of a call is linked or unanswered; of a further result repeated (its call has an
    earlier one), early (it stands before the first call of its id) or orphan (no call has its
    id).  ``occurrence`` numbers the calls of an id from 1; ``n_results`` counts a call's results.

    Messages are parsed twice: for the links, which are made of ids alone, and for the contents, which
    move once to their links and, if they are results, once more to their calls.
    """
    parsed = events(messages, schemas)
    first = lambda *names: (F.first(c).alias(c) for c in names)
    heads = cut(parsed.groupBy("key").agg(*first("conv_id", "turn", "place", "kind", "call_id", "depends_on"), F.count("*").alias("copies")), "events", "zstd")
    whole = parsed.groupBy("key").agg(*first("conv_id", "turn", "place", "call_id", "name", "arguments", "errors", "content")).join(links(heads), "key")
    whole = cut(whole, "contents", "zstd")
    answers = whole.where("status = 'answer'").select(F.col("target").alias("_target"), F.col("content").alias("answer"))
    calls = whole.where("status in ('linked', 'unanswered')").join(answers, F.col("key") == F.col("_target"), "left").drop("_target")
    others = whole.where("status in ('repeated', 'early', 'orphan')").withColumn("answer", F.col("content"))
    valid = F.when(F.col("errors").isNotNull(), F.col("errors") == "")
    names = ("conv_id", "call_id", "occurrence", "status", "name", "turn", "place", "result_turn", "position", "cyclic", "n_results", "copies")
    return calls.unionByName(others).select(*names, valid.alias("valid"), "errors", _written_call(F.col("answer")).alias("canonical"))


def _written_call(result: Column) -> Column:
    """Keys in sorted order; every value is canonical already, or a string to be written as one."""
    return F.concat(F.lit('{"arguments":'), F.coalesce("arguments", F.lit("null")), F.lit(',"id":'), _written(F.col("call_id")), F.lit(',"name":'), F.coalesce(_written(F.col("name")), F.lit("null")), F.lit(',"result":'), F.coalesce(result, F.lit("null")), F.lit("}"))


def _written(text: Column) -> Column:
    """``text`` as a JSON string: to_json escapes what JSON needs and no more."""
    return F.when(text.isNotNull(), F.regexp_extract(F.to_json(F.struct(text.alias("s"))), '(?s)^\\{"s":(.*)\\}$', 1))
