"""Operator 8: secret scans by patterns and a token-efficiency test.

Base kinds (fixed patterns): ``assign`` (a secret-like name, ``:`` or ``=``, a value of
8 or more characters), ``access`` (an access key id of 16 or more characters),
``hex`` (32 or more lower-case hex digits); matches are leftmost and do not overlap
within a kind.

Token efficiency: every run of MIN_RUN or more characters of a secret's alphabet is
encoded with a tiktoken vocabulary. Words of any language in the vocabulary take
several characters per token, random strings little more than one: a ratio below
RATIO is reported as kind ``token``, unless the run is a known digest or identifier
(digest lengths of pure hex digits, UUIDs, dates and numbers without a letter) or part of a
mail address or of a web address's host. Parts joined by full stops, as signed tokens have,
are judged together and, where that finds nothing, one by one; so are the segments of a
web address's path. What a base span leaves of a run is judged like a run.

Scale: one pass per text inside the scan, no shuffle; the vocabulary is loaded
once per Python worker from ``vocabulary``, a path that every executor has.

Defined cases: null text counts as empty and has no span; repeated rows are scanned
each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

#: fixed values: the base patterns
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")       # a maximal run of 32 or more digits
KINDS = ("assign", "access", "hex", "token")
ASSIGN_CHARS, ACCESS_CHARS = 8, 16

MIN_RUN = 16
RATIO = 2.2
RUN = re.compile(r"[A-Za-z0-9+/_=-](?:[A-Za-z0-9+/_=.-]{14,}[A-Za-z0-9+/_=-])")
PART = re.compile(r"[^./]{16,}")                     # of a run with full stops or slashes
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)          # md5, sha1, sha224, sha256, sha384, sha512
DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
IDENTIFIER = re.compile(
    r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"        # uuid
    r"|[0-9]{4}-[0-9]{2}-[0-9]{2}[T_][0-9]{2,6}Z?"              # a date with a time
    r"|[0-9+/_=.-]+")                                           # dates, phone and other plain numbers
#: a web address's scheme and, behind its user-info, its host; a mail address
ADDRESS = re.compile(r"""([A-Za-z][A-Za-z0-9+.-]{0,31}://)(?:[^\s/?\#@]*@)?([^\s/?\#@"'<>(){}\[\],;|]*)""")
MAIL = re.compile(r"(?<![\w.%+:/-])[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


@lru_cache(maxsize=4)
def encoding(vocabulary: str):
    import public_tokenizers
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("scan", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind number, kind, end) in order of start, then kind as listed."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def excluded(run: str) -> bool:
    """Known digests and identifiers."""
    return len(run) in DIGEST_LENGTHS and DIGEST.fullmatch(run) is not None or IDENTIFIER.fullmatch(run) is not None


def addresses(text: str) -> list[tuple[int, int]]:
    """Spans of mail addresses, and of the schemes and hosts of web addresses."""
    out = [m.span(k) for m in ADDRESS.finditer(text) for k in (1, 2)] if "://" in text else []
    return out + [m.span() for m in MAIL.finditer(text)] if "@" in text else out


def parts(a: int, b: int, known: list[tuple[int, int]], first: int = 0) -> list[tuple[int, int]]:
    """What the ascending ``known`` spans, from number ``first`` on, leave of a run, if long enough."""
    out = []
    for i in range(first, len(known)):
        s, e = known[i]
        if s >= b:
            break
        if a < e:
            out.append((a, s))
            a = max(a, e)
    return [(x, y) for x, y in [*out, (a, b)] if y - x >= MIN_RUN]


def token_spans(text: str, base: list[tuple[int, int, int]], enc, ratio: float = RATIO) -> list[tuple[int, int, int]]:
    """Runs of few characters per token outside the base spans and addresses."""
    out, passed = [], 0
    known = sorted(addresses(text) + [(a, b) for a, _, b in base])

    def random(a: int, b: int) -> bool:
        run = text[a:b]
        return b - a >= MIN_RUN and not excluded(run) and len(run) / len(enc.encode_ordinary(run)) < ratio

    for m in RUN.finditer(text):
        while passed < len(known) and known[passed][1] <= m.start():
            passed += 1
        for a, b in parts(m.start(), m.end(), known, passed):
            if random(a, b):
                out.append((a, 3, b))
            elif "." in text[a:b] or "/" in text[a:b]:
                out += [(a + p.start(), 3, a + p.end()) for p in PART.finditer(text[a:b]) if random(a + p.start(), a + p.end())]
    return out


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def scan_udf(vocabulary: str, ratio: float):
    @pandas_udf("n_assign long, n_access long, n_hex long, n_token long, base string, spans string")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = encoding(vocabulary)
        for texts in batches:
            rows = []
            for text in texts.tolist():
                base = base_spans(text)
                extra = token_spans(text, base, enc, ratio)
                count = [sum(k == i for _, k, _ in base) for i in range(3)]
                rows.append((*count, len(extra), spans_text(base), spans_text(base + extra)))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_token", "base", "spans"])
    return scan


def secret_scan(docs: DataFrame, vocabulary: str | None = None, ratio: float = RATIO) -> DataFrame:
    """doc_id, counts per kind, base (base spans) and spans (all spans) as kind:start:end lists."""
    scan = scan_udf(vocabulary or default_vocabulary(), ratio)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       scan(F.coalesce("text", F.lit(""))).alias("s")).select("doc_id", "s.*")


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
