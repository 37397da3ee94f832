"""Secret scans: known shapes by pattern, unknown ones by how little a primed compressor saves on them."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendreach.llm.common import carried, map_arrow

KINDS = ("assign", "access", "hex", "novel")
# fixed patterns of the contract
ASSIGN = re.compile(r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
                    r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
                    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")      # greedy runs, so the same as runs of any length, the short ones dropped
#: what a candidate of the novelty method looks like, and what must stand shortly before it
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
SENSITIVE = re.compile(r"(?i)auth|bearer|credential|key|passw|passphrase|private|pwd|secret|signature|token|login")
AROUND = 256            # code points before and after a candidate that prime the compressor
NEAR = 48               # code points before it in which the sensitive word must stand
#: what may stand between the candidates of one run, as the lines of a key do
JOINT = re.compile(r"(?:\\[nr]|[\s\"'`,;+\\>#*|]){1,64}")
#: the last line of a key, of whatever length
LAST = re.compile(JOINT.pattern + r"([A-Za-z0-9+/=]+)" + JOINT.pattern + r"-----END")
LEAST_BITS = 3.6        # marginal compressed bits a character from which a candidate is reported
#: identifiers that code is full of; they and the text around prime the compressor
IDENTIFIERS = (
    "import return function class public private protected static const let var def self this null None true "
    "false undefined string integer boolean float double long byte char void object array list map dict set "
    "http https www localhost example com org net api v1 v2 user username password passwd secret token access "
    "refresh bearer authorization authentication credential credentials session cookie config configuration "
    "settings environment variable database connection server client request response header content type "
    "application json xml html text utf-8 encoding base64 sha256 md5 digest signature certificate public_key "
    "private_key api_key client_id client_secret access_token refresh_token account_id created_at updated_at "
    "description parameter argument exception error warning message handler callback listener controller service "
    "repository factory builder manager provider template component container index length size count value "
    "0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ")


class Novelty:
    """Marginal cost of a string: compressed size of context and string less that of the context alone."""

    def __init__(self, identifiers: str = IDENTIFIERS, level: int = 3):
        primed = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.pack = zstandard.ZstdCompressor(level=level, dict_data=primed, write_content_size=False,
                                             write_checksum=False, write_dict_id=False).compress

    def bits(self, context: str, candidate: str) -> float:
        """Bits a character that ``candidate`` adds to its context."""
        around, own = (s.encode("utf-8", "surrogatepass") for s in (context, candidate))
        return 8.0 * (len(self.pack(around + own)) - len(self.pack(around))) / max(1, len(own))


def find_secrets(text: str | None, novelty: Novelty) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) in code points, by start and then kind as listed in ``KINDS``.

    Patterns are matched leftmost and without overlap within their kind; failing matches (assigned values
    under 6 characters, access keys under 20) are dropped after they have used up their text. Novel spans
    touch no other span; the sensitive word before a candidate holds for all that adjoin it. A null text is empty.
    """
    if not text:
        return []
    spans = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    spans.sort(key=lambda s: (s[0], s[2]))
    extra, i, reach = [], 0, 0
    end, sensitive = -1, False      # of the run of adjoining candidates so far
    for m in CANDIDATE.finditer(text):
        while i < len(spans) and spans[i][0] < m.end():
            reach = max(reach, spans[i][1])
            i += 1
        word = m[0]
        near = SENSITIVE.search(text[max(0, m.start() - NEAR):m.start()])
        joined = end >= 0 and JOINT.fullmatch(text, end, m.start())
        sensitive, end = bool(near or joined and sensitive), m.end()
        if reach > m.start() or not sensitive:
            continue
        if not any(c.isdigit() for c in word) or not any(c.isalpha() for c in word):
            continue
        # copies of the candidate around it, cut ones too, would make it look known
        wide = AROUND + len(word)
        around = (text[max(0, m.start() - wide):m.start()].replace(word, " ")[-AROUND:]
                  + text[end:end + wide].replace(word, " ")[:AROUND])
        if novelty.bits(around, word) >= LEAST_BITS:
            extra.append((m.start(), m.end(), 3))
            last = LAST.match(text, end)
            if last and not any(a < last.end(1) and z > last.start(1) for a, z, _ in spans):
                extra.append((*last.span(1), 3))
                reach = max(reach, last.end(1))
    if extra:
        spans = sorted(spans + extra, key=lambda s: (s[0], s[2]))
    return [(a, z, KINDS[k]) for a, z, k in spans]


def _spelled(spans) -> str:
    return ",".join(f"{k}:{a}:{z}" for a, z, k in spans)


def scan_secrets(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), redact: str | None = None,
                 text: str = "text") -> DataFrame:
    """Columns ``keep`` with ``found`` (start, end, kind) of every whole text, their counts and digest.

    Adds n_assign, n_access, n_hex, n_novel, base_sha256 and spans; with ``redact`` also ``clean_text``, the
    text with every run of overlapping spans replaced by that string (null stays null). One row in, one row out.
    """
    kept, body = carried(docs, keep, text)

    def run(batches):
        novelty = Novelty()
        for b in batches:
            texts = b.column(body).to_pylist()
            found = [find_secrets(t, novelty) for t in texts]
            base = [[s for s in f if s[2] != "novel"] for f in found]
            cols = [*[b.column(c) for c in keep],
                    pa.array([[{"start": a, "end": z, "kind": k} for a, z, k in f] for f in found], SPANS)]
            cols += [pa.array([sum(s[2] == k for s in f) for f in found], pa.int64()) for k in KINDS]
            cols += [pa.array([hashlib.sha256(_spelled(f).encode()).hexdigest() for f in base], pa.string()),
                     pa.array([_spelled(f) for f in found], pa.string())]
            if redact is not None:
                cols.append(pa.array([redacted(t, f, redact) for t, f in zip(texts, found, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = kept.select(*keep).schema.add("found", T.ArrayType(
        T.StructType().add("start", "long").add("end", "long").add("kind", "string")))
    for k in KINDS:
        schema = schema.add(f"n_{k}", "long")
    schema = schema.add("base_sha256", "string").add("spans", "string")
    if redact is not None:
        schema = schema.add("clean_text", "string")
    names = schema.names
    return map_arrow(kept, run, schema)


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))


def redacted(text: str | None, spans, mark: str) -> str | None:
    if not spans:
        return text
    out, at, reach = [], 0, 0
    for a, z, _ in spans:
        if a >= reach:
            out += [text[at:a], mark]
        reach = max(reach, z)
        at = reach
    return "".join([*out, text[at:]])
