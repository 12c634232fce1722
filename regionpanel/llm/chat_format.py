"""Records of many chat layouts as turns, and turns as training text with a loss mask.

A record is one JSON object. The set of its nested field paths (``messages[].content``) is hashed; the hash selects the
declarative mapping that says where the turns stand. A worker settles each fingerprint once, by the mapping with the most
of its fields among the paths; nothing about records is gathered. Turns are then rendered by Spark's own functions, one
piece of text per turn: marks around role and text, and control strings inside either broken by an escape. Pieces of a
conversation, one after the other, are its formatted text, and every piece can be read alone; so a conversation of any
length is spread over rows.

Defined results: a null or missing field is an empty text; numbers and other values read as JSON; fields no mapping names
are ignored; a record that is null, no JSON object or of unknown layout keeps its row, with ``layout`` and ``turns`` null;
an empty list of messages gives no turns; empty texts give empty turns; very long texts are one value; records alike give
turns alike; an empty table gives no rows; other columns stay, those of the names added give way.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fingerprints a worker remembers; beyond, it settles them again.
KNOWN_MOST = 100_000
TURNS = "array<struct<role: string, text: string>>"
TURN_LIST = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
ADDED = ("fingerprint", "layout", "turns")


@dataclass(frozen=True)
class Says:
    """One turn of a fixed role; its text is that of the fields, empty ones left out, with an empty line between them.

    ``optional`` turns may be missing or empty and are left out then.
    """

    role: str
    fields: tuple[str, ...]
    optional: bool = False


@dataclass(frozen=True)
class Each:
    """A turn per element of a list; ``text`` names alternatives. ``names`` are other words for roles."""

    items: str
    role: str
    text: tuple[str, ...]
    names: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Mapping:
    layout: str
    parts: tuple[Says | Each, ...]

    def fields(self, paths: frozenset[str]) -> int:
        """How many of the mapping's fields the paths have; 0 if one that is needed is missing."""
        count = 0
        for part in self.parts:
            if isinstance(part, Says):
                have = sum(f in paths for f in part.fields)
                if not have and not part.optional:
                    return 0
            else:
                have = (f"{part.items}[].{part.role}" in paths) * sum(f"{part.items}[].{t}" in paths for t in part.text)
                have = have + 1 if have else f"{part.items}[]" in paths
                if not have:
                    return 0
            count += have
        return count

    def turns(self, record: dict[str, Any]) -> list[tuple[str, str]]:
        out = []
        for part in self.parts:
            if isinstance(part, Says):
                texts = [t for t in (text_of(record, f) for f in part.fields) if t]
                if texts or not part.optional:
                    out.append((part.role, "\n\n".join(texts)))
            else:
                names = dict(part.names)
                for item in next(values(record, part.items.split(".")), None) or ():
                    role = text_of(item, part.role)
                    out.append((names.get(role, role), "".join(text_of(item, t) for t in part.text)))
        return out


_SHARED = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"))
_SYSTEM = Says("system", ("system",), optional=True)
#: Layouts that public chat and instruction sets come in.
LAYOUTS = (
    Mapping("messages", (Each("messages", "role", ("content", "content[].text")),)),
    Mapping("from_value", (_SYSTEM, Each("conversations", "from", ("value",), _SHARED))),
    Mapping("instruction", (_SYSTEM, Says("user", ("instruction", "input", "context")), Says("assistant", ("output", "response")))),
    Mapping("prompt_completion", (_SYSTEM, Says("user", ("prompt",)), Says("assistant", ("completion", "response")))),
    Mapping("question_answer", (_SYSTEM, Says("user", ("question",)), Says("assistant", ("answer", "response")))),
)


def paths_of(value: Any, path: str = "") -> Iterator[str]:
    """Paths to the leaves of a value; an empty list or object is a leaf."""
    if isinstance(value, dict) and value:
        for k, v in value.items():
            yield from paths_of(v, f"{path}.{k}" if path else k)
    elif isinstance(value, list):
        if not value:
            yield f"{path}[]"
        for v in value:
            yield from paths_of(v, f"{path}[]")
    else:
        yield path


def values(value: Any, path: Sequence[str]) -> Iterator[Any]:
    """What stands at a path, walking into all elements of its lists."""
    if not path:
        yield value
        return
    name, many = path[0].removesuffix("[]"), path[0].endswith("[]")
    found = value.get(name) if isinstance(value, dict) else None
    if many:
        for v in found if isinstance(found, list) else ():
            yield from values(v, path[1:])
    elif found is not None:
        yield from values(found, path[1:])


def text_of(value: Any, path: str) -> str:
    """Texts at a path, joined; a list where the path ends has its own path and no text here."""
    found = (v for v in values(value, path.split(".")) if v is not None and not isinstance(v, list))
    return "".join(v if isinstance(v, str) else json.dumps(v, ensure_ascii=False) for v in found)


def fingerprint(paths: frozenset[str]) -> int:
    """Signed 64-bit hash of a set of paths."""
    return int.from_bytes(xxhash.xxh3_64_digest("\n".join(sorted(paths)).encode("utf-8", "surrogatepass")), "big", signed=True)


def choose(paths: frozenset[str], layouts: Sequence[Mapping]) -> Mapping | None:
    """The mapping with the most fields among the paths, the first of those."""
    counts = [m.fields(paths) for m in layouts]
    return layouts[counts.index(max(counts))] if counts and max(counts) else None


def canonical(records: DataFrame, record: str = "record", layouts: Sequence[Mapping] = LAYOUTS) -> DataFrame:
    """``records`` with ``fingerprint`` (of the field paths), ``layout`` and ``turns`` (role and text)."""
    layouts = tuple(layouts)
    known: dict[int, Mapping | None] = {}

    def settled(text: str | None) -> tuple[int | None, str | None, list[tuple[str, str]] | None]:
        try:
            value = json.loads(text) if text is not None else None
            paths = frozenset(paths_of(value))
        except (ValueError, RecursionError):
            return None, None, None
        if not isinstance(value, dict):
            return None, None, None
        mark = fingerprint(paths)
        if mark not in known:
            if len(known) >= KNOWN_MOST:
                known.clear()
            known[mark] = choose(paths, layouts)
        mapping = known[mark]
        return (mark, mapping.layout, mapping.turns(value)) if mapping else (mark, None, None)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [settled(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            marks, names, turns = zip(*rows, strict=True) if rows else ((), (), ())
            said = [None if t is None else [{"role": r, "text": x} for r, x in t] for t in turns]
            added = [pa.array(marks, pa.int64()), pa.array(names, pa.string()), pa.array(said, TURN_LIST)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], names=[*batch.schema.names[:-1], *ADDED])

    kept = records.drop(*ADDED)
    schema = T.StructType([*kept.schema.fields, *T.StructType.fromDDL(f"fingerprint long, layout string, turns {TURNS}").fields])
    return kept.withColumn(f"_{record}", F.col(f"`{record}`")).mapInArrow(read, schema)


ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """What stands around role and text of a turn. All three contain a ``<`` at their beginning only."""

    begin: str = "<turn>"
    says: str = "<says>"
    end: str = "</turn>"
    after: str = "\n"

    @property
    def controls(self) -> tuple[str, ...]:
        return self.begin, self.says, self.end


TEMPLATE = Template()


def escaped(text: Column, template: Template = TEMPLATE) -> Column:
    """Escapes doubled, then every control string broken by one after its first letter, so that none stands as it is."""
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for control in template.controls:
        text = F.replace(text, F.lit(control), F.lit(control[0] + ESCAPE + control[1:]))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def render(turns: DataFrame, learn: Sequence[str] = ("assistant",), template: Template = TEMPLATE) -> DataFrame:
    """``turns`` (``role``, ``text``) as ``piece``, with the part of it that counts for the loss: the text of turns of the
    roles ``learn``, from the code point ``loss_from`` (0-based) on, ``loss_length`` long; null where nothing is learnt."""
    role, text = (escaped(F.coalesce(F.col(c), F.lit("")), template) for c in ("role", "text"))
    head = F.concat(F.lit(template.begin), role, F.lit(template.says))
    learnt = F.col("role").isin(*learn)
    return turns.select(
        *[F.col(f"`{c}`") for c in turns.drop("role", "text", "piece", "loss_from", "loss_length").columns],
        F.concat(head, text, F.lit(template.end + template.after)).alias("piece"),
        F.when(learnt, F.length(head).cast("long")).alias("loss_from"),
        F.when(learnt, F.length(text).cast("long")).alias("loss_length"),
    )


def read_back(pieces: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Pieces with ``role`` and ``text`` again, and ``learnt``: the unescaped text under the loss mask, null if none."""
    body = rf"(?s)\A{re.escape(template.begin)}(.*?){re.escape(template.says)}(.*){re.escape(template.end + template.after)}\z"
    masked = F.substring("piece", F.col("loss_from").cast("int") + 1, F.col("loss_length").cast("int"))
    return pieces.select(
        "*",
        unescaped(F.regexp_extract("piece", body, 1)).alias("role"),
        unescaped(F.regexp_extract("piece", body, 2)).alias("text"),
        unescaped(masked).alias("learnt"),
    )


def conversations(pieces: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Whole conversations: ``key``, ``formatted`` and ``loss`` (from and length of every span, in code points).

    A conversation becomes one value here, as trainers want it; Spark holds it to 2 GB.
    """
    row = F.struct(*order, "piece", "loss_from", "loss_length")
    rows = pieces.groupBy(key).agg(F.array_sort(F.collect_list(row)).alias("r"))
    lengths = F.transform("r", lambda x: F.length(x["piece"]).cast("long"))
    begins = F.aggregate(
        lengths, F.array(F.lit(0).cast("long")), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n))
    )
    spans = F.filter(
        F.zip_with("r", F.slice(begins, F.lit(1), F.size("r")), lambda x, b: F.struct((b + x["loss_from"]).alias("from"), x["loss_length"].alias("length"))),
        lambda s: s["from"].isNotNull(),
    )
    return rows.select(key, F.array_join(F.transform("r", lambda x: x["piece"]), "").alias("formatted"), spans.alias("loss"))
