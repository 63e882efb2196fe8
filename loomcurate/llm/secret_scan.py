"""Secret scans: three fixed patterns, and strings that their surroundings do not explain.

The base kinds are patterns. The method's kind, ``novel``, measures a candidate's marginal compressed bytes: zstandard
is primed with a dictionary of common identifiers and the text around the candidate, and the bytes that the candidate
then adds are compared with its length. Ordinary words, repeated identifiers, paths and numbers that the surroundings
hold compress to little; keys do not. Other places of the candidate itself do not count as surroundings, so a key that is
set and then used is found at both, unless it reads as words, as a repeated identifier does. A candidate is a run of 16 or more key characters with a digit and a letter, or
with both cases, and it is measured only in a sensitive context: a sensitive word among the characters just before it.

Everything happens inside one document, in one pass with no shuffle. Cheap exact byte filters skip documents that
cannot match. Offsets are code points of the whole text, end exclusive.

Defined cases: null or empty text has no spans; repeated rows are reported each; a match that fails its length test
still consumes its characters; base spans are reported whether or not a novel span covers them; texts of any
length are scanned whole; an empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import ready

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST, NOVEL_LEAST = 12, 18, 16, 16
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
SENSITIVE = re.compile(r"passw(?:or)?d|passphrase|secret|token|api[ _-]?key|access[ _-]?key|private[ _-]?key|credential|authorization|bearer|client[ _-]?id|signature", re.IGNORECASE | re.ASCII)
SENSITIVE_WORDS = ("passw", "passphrase", "secret", "token", "key", "credential", "authorization", "bearer", "client", "signature")
#: Characters before a candidate that are searched for a sensitive word, and around it that prime the compressor.
REACH, SURROUND = 64, 400
#: Marginal bytes per character from which a candidate is reported; a random hex string needs 0.5, base64 0.75.
NOVELTY = 0.5
#: Pieces of a name. Random keys change class every 2 characters (base64, hex) or 3.2 (base32), names every word.
PIECE, WORD_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+"), 4
IDENTIFIERS = (
    "access_key access_token account_id accessKeyId accessToken api_key apiKey application/json app_secret auth_token authorization "
    "aws_access_key_id aws_secret_access_key bearer certificate client_id client_secret config connection_string content-type "
    "credentials database_url default environment example export function getenv github_token https:// http:// id_rsa "
    "import key_id localhost member organization os.environ parameter password passphrase placeholder private_key public_key "
    "refresh_token request_id response return secret_key secretKey self.token service_account session_id set_password signature "
    "ssh-rsa string token_type undefined user_name username value variable your_api_key_here changeme "
    "0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ xxxxxxxxxxxxxxxx 0000000000000000 1234567890123456"
)


def _table(letters: str) -> bytes:
    marks = bytearray(256)
    for c in letters.encode():
        marks[c] = 1
    return bytes(marks)


_HEX = _table("0123456789abcdef")
_KEY = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")
_HEX_RUN, _KEY_RUN = b"\1" * HEX_LEAST, b"\1" * NOVEL_LEAST


def base_spans(text: str, raw: bytes, low: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns."""
    found = []
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    if _HEX_RUN in raw.translate(_HEX):
        found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def novelty(candidate: str, around: str, identifiers: str = IDENTIFIERS) -> float:
    """Marginal compressed bytes per character of ``candidate``, given its surroundings and the identifiers."""
    primed = zstandard.ZstdCompressionDict(f"{identifiers}\n{around}".encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    press = zstandard.ZstdCompressor(level=19, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)
    return (len(press.compress(candidate.encode())) - len(press.compress(b""))) / len(candidate)


def reads_as_words(candidate: str) -> bool:
    """Whether a candidate's pieces (words of a name, numbers) have WORD_PIECE characters or more on average."""
    pieces = PIECE.findall(candidate)
    return sum(map(len, pieces)) >= WORD_PIECE * len(pieces)


def novel_spans(text: str, raw: bytes, low: str, least: float = NOVELTY) -> list[tuple[int, int, str]]:
    if not any(w in low for w in SENSITIVE_WORDS) or _KEY_RUN not in raw.translate(_KEY):
        return []
    found = []
    for m in CANDIDATE.finditer(text):
        word = m[0]
        has_digit, has_case = any(c.isdigit() for c in word), word.lower() != word and word.upper() != word
        if not (has_digit and any(c.isalpha() for c in word)) and not (has_case and not word.istitle()):
            continue
        # a sensitive word inside the run counts too: key=value without spaces
        if not SENSITIVE.search(text, max(0, m.start() - REACH), m.end()):
            continue
        around = text[max(0, m.start() - SURROUND) : m.start()] + " " + text[m.end() : m.end() + SURROUND]
        if not reads_as_words(word):
            around = around.replace(word, " ")  # other places of the same key explain nothing: set, then used
        if novelty(word, around) >= least:
            found.append((m.start(), m.end(), "novel"))
    return found


def spans(text: str | None) -> list[tuple[int, int, str]]:
    """All spans, by start, then kind as listed."""
    if not text:
        return []
    raw, low = text.encode("utf-8", "surrogatepass"), text.lower()
    found = base_spans(text, raw, low) + novel_spans(text, raw, low)
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _joined(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and an array of spans (kind, start, end): a row per document."""
    return _scan(docs, key, text, "spans array<struct<kind:string,start:long,end:long>>", lambda found: [[{"kind": k, "start": a, "end": b} for a, b, k in found]])


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """doc_id and the text with each union of overlapping spans replaced by ``mark``."""

    def rewrite(found, whole):
        out, at = [], 0
        for start, end, _ in found:
            if start >= at:
                out += [whole[at:start], mark]
            at = max(at, end)
        return [None if whole is None else "".join(out) + whole[at:]]

    return _scan(docs, key, text, "text string", rewrite, with_text=True)


def _scan(docs: DataFrame, key: str, text: str, schema: str, row, with_text: bool = False) -> DataFrame:
    ready(docs.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    kind = docs.schema[key].dataType.simpleString()
    fields = _parse_datatype_string(f"doc_id {kind}, {schema}")
    types = list(to_arrow_schema(StructType(fields.fields)).types)
    names = fields.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [batch.column(0).to_pylist(), *([] for _ in names[1:])]
            for whole in batch.column(1):
                whole = whole.as_py()
                found = spans(whole)
                for column, value in zip(columns[1:], row(found, whole) if with_text else row(found), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return docs.select(key, text).mapInArrow(run, fields)


def _digest(found: list[tuple[int, int, str]]) -> list:
    base = [s for s in found if s[2] != "novel"]
    return [*(sum(s[2] == k for s in base) for k in KINDS[:3]), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(found)]


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: a row per document."""
    return _scan(docs, "doc_id", "text", "n_assign long, n_access long, n_hex long, base_sha256 string, spans string", _digest)
