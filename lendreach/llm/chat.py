"""Chat formatting: a record's layout is told by the hash of its nested field paths, a declarative mapping turns it
into canonical turns, and a template with reversible escapes joins the turns of a conversation."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendreach.llm.common import map_arrow
from lendreach.session import cut_lineage

OPEN, CLOSE = "<turn", "</turn>\n"
SEGMENT = 1 << 20       # characters after which a long conversation goes on in another row


# ---- layouts ---------------------------------------------------------------------------------------

def field_paths(record) -> frozenset[str]:
    """Nested field paths; a list's items share the path ``[]``. An empty object or list is its own path."""
    out: set[str] = set()
    stack = [("", record)]
    while stack:
        at, x = stack.pop()
        if isinstance(x, dict) and x:
            stack += [(f"{at}.{k}" if at else k, v) for k, v in x.items()]
        elif isinstance(x, list) and x:
            stack += [(f"{at}[]", v) for v in x]
        else:
            out.add(at)
    return frozenset(out)


def fingerprint(paths: frozenset[str]) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


@dataclass(frozen=True)
class Turn:
    """A turn whose text stands at ``text``; its role is fixed, or stands at the path ``role``."""
    text: str
    is_a: str | None = None
    role: str | None = None


@dataclass(frozen=True)
class Each:
    """A turn for every item of the list at ``items``."""
    items: str
    text: str
    role: str


@dataclass(frozen=True)
class Layout:
    """What a layout holds, and how it becomes turns. ``order`` is the path of a row's place where every turn is
    a record of its own; optional paths may be missing, empty optional texts give no turn."""
    name: str
    steps: tuple[Turn | Each, ...]
    order: str | None = None
    optional: tuple[str, ...] = ()
    names: Mapping[str, str] = field(default_factory=dict)

    def paths(self) -> frozenset[str]:
        out = {self.order} if self.order else set()
        for s in self.steps:
            inner = [s.text, *([s.role] if s.role else [])]
            out |= {f"{s.items}[].{p}" if isinstance(s, Each) else p for p in inner}
        return frozenset(out)


SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
LAYOUTS = (
    Layout("prompt-row", (Turn("prompt", "user"),), order="turn"),
    Layout("instruction-row", (Turn("instruction", "system"),), order="turn"),
    Layout("message-row", (Turn("message.content", role="message.role"),), order="turn"),
    Layout("prompt", (Turn("system", "system"), Turn("prompt", "user"), Turn("completion", "assistant")),
           optional=("system",)),
    Layout("response", (Turn("prompt", "user"), Turn("response", "assistant"))),
    Layout("instruction", (Turn("instruction", "user"), Turn("input", "user"), Turn("output", "assistant")),
           optional=("input",)),
    Layout("messages", (Each("messages", "content", "role"),), names=SPEAKERS),
    Layout("parts", (Each("messages", "content[].text", "role"),), names=SPEAKERS),
    Layout("speakers", (Turn("system", "system"), Each("conversations", "value", "from")), optional=("system",),
           names=SPEAKERS),
)


class Mappings:
    """Layouts by fingerprint. A record with further fields takes the layout with most paths among those it has
    all of (ties: the first name); that is looked up once a fingerprint."""

    def __init__(self, layouts: tuple[Layout, ...]):
        self.layouts = layouts
        self.known: dict[str, Layout | None] = {}
        for x in layouts:
            for k in range(len(x.optional) + 1):
                for gone in combinations(x.optional, k):
                    self.known.setdefault(fingerprint(x.paths() - set(gone)), x)

    def of(self, record) -> tuple[str, Layout | None]:
        paths = field_paths(record)
        name = fingerprint(paths)
        if name not in self.known:
            fits = [x for x in self.layouts if x.paths() - set(x.optional) <= paths]
            self.known[name] = min(fits, key=lambda x: (-len(x.paths() & paths), x.name), default=None)
        return name, self.known[name]


def _at(record, path: str) -> list:
    """What stands at a path; several values where it passes a list."""
    found = [record]
    for step in re.findall(r"\[\]|[^.\[\]]+", path):
        if step == "[]":
            found = [y for x in found if isinstance(x, list) for y in x]
        else:
            found = [x[step] for x in found if isinstance(x, dict) and step in x]
    return found


def _text(values: list) -> str:
    """Null is empty; what is no string is its JSON; several values follow each other. Half a surrogate pair,
    which no text can hold, is U+FFFD."""
    out = "".join(v if isinstance(v, str) else "" if v is None else json.dumps(v, ensure_ascii=False) for v in values)
    return out if out.isascii() else re.sub("[\ud800-\udfff]", "\ufffd", out)


def turns_of(record, layout: Layout) -> Iterator[tuple[str, str]]:
    for s in layout.steps:
        for item in _at(record, f"{s.items}[]") if isinstance(s, Each) else [record]:
            if isinstance(s, Turn) and s.text in layout.optional and not _text(_at(record, s.text)):
                continue
            role = _text(_at(item, s.role)) if s.role else s.is_a
            yield layout.names.get(role, role), _text(_at(item, s.text))


TURNS = "conv_id long, seq long, place int, role string, text string, layout string, fingerprint string"


def canonical_turns(records: DataFrame, key: str = "conv_id", record: str = "record",
                    layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv_id, seq, place, role, text, layout, fingerprint): the turns of JSON records of any known layout.

    ``seq`` is a row's own place where every turn is a record, else 0; ``place`` counts within the record. A
    record that no layout fits (or that is null or no JSON) is one row with null layout, its JSON as text.
    """
    names = [c.split()[0] for c in TURNS.split(", ")]

    def run(batches):
        maps = Mappings(layouts)
        for b in batches:
            out: list[list] = [[] for _ in names]

            def tell(*values):
                for c, v in zip(out, values, strict=True):
                    c.append(v)
            for k, raw in zip(b.column("k").to_pylist(), b.column("r").to_pylist(), strict=True):
                try:
                    x = json.loads(raw or "null")
                except (ValueError, RecursionError):
                    x = None
                name, layout = maps.of(x) if isinstance(x, (dict, list)) else (None, None)
                if layout is None:
                    tell(k, None, 0, None, raw, None, name)
                    continue
                seq = _at(x, layout.order)[:1] if layout.order else [0]
                seq = seq[0] if seq and type(seq[0]) is int and -2**63 <= seq[0] < 2**63 else None
                for place, (role, text) in enumerate(turns_of(x, layout)):
                    tell(k, seq, place, role, text, layout.name, name)
            types = [pa.int64(), pa.int64(), pa.int32(), *[pa.string()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

    return map_arrow(records.select(F.col(key).cast("long").alias("k"), F.col(record).alias("r")), run, TURNS)


# ---- template --------------------------------------------------------------------------------------

_CONTROL, _IN_ROLE = re.compile(r"\\|</?turn"), re.compile(r"[\\<>]")
_TURN = re.compile(r"<turn ((?:[^\\>]|\\.)*)>((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.S)


def escape(text: str) -> str:
    """A backslash before every backslash and before what begins a control string."""
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def formatted(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where its text begins and ends."""
    head = f"{OPEN} {_IN_ROLE.sub(lambda m: chr(92) + m[0], role)}>"
    body = escape(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


def read_back(text: str) -> list[tuple[str, str]]:
    """Role and text of every turn of a formatted text; anything else in it is an error."""
    out, at = [], 0
    while at < len(text):
        m = _TURN.match(text, at)
        if m is None:
            raise ValueError(f"no turn at character {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


SEGMENTS = ("conv_id long, seq long, place int, tie long, part long, n_turns int, formatted string, "
            "loss array<struct<start:int,end:int>>")
ORDER = ["conv_id", "seq", "place", "tie", "part"]


def format_chats(turns: DataFrame, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, seq, place, tie, part, n_turns, formatted, loss): conversations in the template, with the spans
    (code points) of the texts that are learned, those of the roles ``learn``.

    Turns follow (seq, place), ties by a hash of role and text; null comes first. The table is sorted by ranges
    of (conv_id, seq, place, tie), so a conversation of any length is spread over tasks; it is one row, or
    several rows in the order of ``ORDER`` where it passes ``SEGMENT`` characters or the end of a task's range.
    A repeated turn counts each time; a null text or role is empty; null conv_ids are one conversation; records
    without a layout are left out (see ``unmapped``). An empty table gives no row.
    """
    def run(batches):
        part = 0
        key, first, texts, spans, chars = None, None, [], [], 0

        def segment():
            return pa.RecordBatch.from_pylist(
                [{**dict(zip(ORDER[:4], first, strict=True)), "part": part, "n_turns": len(texts),
                  "formatted": "".join(texts), "loss": spans}], schema)
        for b in batches:
            done = []
            for row in zip(*(b.column(c).to_pylist() for c in (*ORDER[:4], "role", "text")), strict=True):
                if texts and (row[0] != key or chars >= SEGMENT):
                    done.append(segment())
                    part, texts, spans, chars = part + 1, [], [], 0
                if not texts:
                    key, first = row[0], row[:4]
                text, a, z = formatted(row[4], row[5])
                if row[4] in learn:
                    spans.append({"start": chars + a, "end": chars + z})
                texts.append(text)
                chars += len(text)
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
        if texts:
            yield segment()

    schema = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("place", pa.int32()), ("tie", pa.int64()),
                        ("part", pa.int64()), ("n_turns", pa.int32()), ("formatted", pa.string()),
                        ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
    rows = turns.filter("layout is not null").select(
        "conv_id", "seq", "place", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("role", "text"))
    ordered = rows.repartitionByRange(*ORDER[:4]).sortWithinPartitions(*ORDER[:4], "role", "text")
    return map_arrow(ordered.select(*ORDER[:4], "role", "text"), run, SEGMENTS)


def unmapped(turns: DataFrame) -> DataFrame:
    """(conv_id, fingerprint, record) of the records that no layout fits."""
    return turns.filter("layout is null").select("conv_id", "fingerprint", F.col("text").alias("record"))


class _Digest:
    """Digests of one conversation, fed segment by segment."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.learned = self.chars = 0

    def add(self, text: str, spans: list[dict]) -> None:
        for role, body in read_back(text):
            self.turns.update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
            self.n += 1
        for s in spans:
            body = unescape(text[s["start"]:s["end"]])
            self.loss.update(body.encode("utf-8", "surrogatepass"))
            self.learned += len(body)
        self.chars += len(text)

    def row(self) -> tuple:
        return self.n, self.turns.hexdigest(), self.learned, self.loss.hexdigest(), self.chars


DIGESTS = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
_TYPES = ["long", "string", "long", "string", "long"]


def digests(chats: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from formatted text.

    A conversation that lies inside one task's range is finished there; of those that touch a range's ends (two a
    task at most) the segments are sorted together and read one after the other. No task holds more than a
    segment.
    """
    def inner(batches):
        """Finishes conversations of one segment between two others; hands on all other segments."""
        number, held, alone = 0, None, False
        for b in batches:
            out = []
            for r in b.to_pylist():
                if held is not None and r["conv_id"] == held["conv_id"]:
                    out += [passed(x) for x in ([held] if alone else []) + [r]]
                    alone = False
                    continue
                if alone:
                    out.append(finished(held) if number > 1 else passed(held))
                number, held, alone = number + 1, r, True
            yield batch(out)
        if alone:
            yield batch([passed(held)])

    def passed(r: dict) -> tuple:
        return (*(r[c] for c in ORDER), r["formatted"], r["loss"], *[None] * len(DIGESTS))

    def finished(r: dict) -> tuple:
        d = _Digest()
        d.add(r["formatted"], r["loss"])
        return (r["conv_id"], *[None] * 6, *d.row())

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    def through(batches):
        """Reads the segments of one conversation after another."""
        last, state = None, None
        for b in batches:
            out = []
            for r in b.to_pylist():
                if state is None or r["conv_id"] != last:
                    if state is not None:
                        out.append((last, *state.row()))
                    last, state = r["conv_id"], _Digest()
                state.add(r["formatted"], r["loss"])
            yield result(out)
        if state is not None:
            yield result([(last, *state.row())])

    def result(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [()] * (1 + len(DIGESTS))
        types = [schema.field(c).type for c in ("conv_id", *DIGESTS)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["conv_id", *DIGESTS])

    long, text = pa.int64(), pa.string()
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    schema = pa.schema([("conv_id", long), ("seq", long), ("place", pa.int32()), ("tie", long), ("part", long),
                        ("formatted", text), ("loss", span), ("n_turns", long), ("turns_sha256", text),
                        ("loss_chars", long), ("loss_sha256", text), ("formatted_chars", long)])
    told = ", ".join(f"{c} {t}" for c, t in zip(DIGESTS, _TYPES, strict=True))
    runs = cut_lineage(map_arrow(
        chats.select(*ORDER, "formatted", "loss"), inner,
        "conv_id long, seq long, place int, tie long, part long, formatted string, "
        f"loss array<struct<start:int,end:int>>, {told}"), "chats")
    rest = runs.filter("formatted is not null").select(*ORDER, "formatted", "loss")
    rest = map_arrow(rest.repartition("conv_id").sortWithinPartitions(*ORDER), through, f"conv_id long, {told}")
    return runs.filter("formatted is null").select("conv_id", *DIGESTS).unionByName(rest)
