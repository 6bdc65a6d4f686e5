"""Secret scan: fixed patterns, and strings that a primed compressor finds new.

The patterns (``assign``, ``access``, ``hex``) give the base spans. On top,
every run of 12 or more characters other than space, brackets and quotes in a
sensitive context is compressed with zstandard, primed with the code around it
and a dictionary of common identifiers: the marginal bytes, over the token's
length, are its novelty. A token made of known words is cheap; a random one
costs its whole length. Long tokens are measured in pieces too short for
entropy coding, so that only repeats, not a small alphabet, make them cheap; a
token's own copies nearby do not prime it. To the compressor a rare word of
prose is as new as a key, so a token that consists of words for at least half
(runs of letters such as prose and identifiers have) must also hold enough
pairs of letters that ordinary words do not; digits, marks and mixed cases
need no such proof. Novel tokens that no base span holds whole are reported as
``novel``.
"""
from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame

from usagelens.llm.common import per_row, text_or_empty

KINDS = ("assign", "access", "hex", "novel")
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_ASSIGN = re.compile("(?:%s|%s_?%s)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)" % (
    "|".join(map(_either, ("password", "passwd", "secret", "token"))), _either("api"), _either("key")))
# a failing run of these two can hold no other match, so the least length may stand in the pattern
_ACCESS = re.compile("AKIA[A-Z0-9]{14,}")
_HEX = re.compile("[0-9a-f]{16,}")
_TOKEN = re.compile(r"""(?![.,;:!?*'\-]+(?:\s|$))[^\s"`'<>()\[\]{},;]{12,}""")
_NAME = re.compile(r"(?:[A-Za-z]?[a-z]{2,}|[A-Z]{3,})(?:[_.-](?:[A-Za-z]?[a-z]{2,}|[A-Z]{3,}))*[=:]+")
_NUMBERS = re.compile(r"\+?\d{1,4}(?:[./:_-]\d{1,4})+")
#: What a candidate loses at its ends: marks of the sentence or line around it.
_FRONT, _BACK = re.compile(r"(?:([^\w\s])\1+)?"), re.compile(r"(?:([^\w\s=])\1+|[.:!?])?$")
#: Runs of letters as in prose and identifiers; a token of which they make up half is taken for words.
_WORDY = re.compile(r"[A-Z]?[^\W\d_A-Z]{3,}|[A-Z]{4,}")
_SENSITIVE = re.compile("|".join(map(_either, (
    "secret", "token", "passw", "passphrase", "credential", "apikey", "api_key", "api-key", "private", "auth", "bearer", "signature"))))
_WORDS = re.compile(r"[^\W_]")
#: Characters measured at once: from 64 on zstandard codes literals by their entropy. ``OWN``: characters of a token that prime its next piece.
PIECE, OWN = 63, 512
#: Share of unknown pairs of characters from which a token is no ordinary word.
STRANGE = 0.3
#: Words that code and configuration are made of; fixed values that prime the compressor.
IDENTIFIERS = (
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 "
    "access account address api_key application argument array assert async authorization await base64 bearer boolean "
    "buffer bytes callback certificate class client close column config configuration connect connection const context "
    "copyright count create credential data database date decode default define delete description digest directory "
    "document email encode encrypt endpoint environment error event example exception execute export extends false "
    "field file filter final float format function global handle hash header host http https identifier implements "
    "import include index init input insert instance integer interface key length license list load local login "
    "localhost long main manager map message method model module name namespace new next node none null number object "
    "open option order output package parameter parent parse passphrase passwd password path pattern permission port "
    "prefix print private process profile property protected protocol provider public query queue read record "
    "reference register release remote request require reset resource response result return role root schema script "
    "search secret security select self send server service session set setting signature size source start state "
    "static status stop storage stream string struct suffix system table target task template test text thread time "
    "timeout timestamp title token true type update upload url user username uuid value variable vector version view "
    "void window worker write").encode()


def pairs(word: str) -> set[str]:
    return {word[i:i + 2] for i in range(len(word) - 1)}


_KNOWN_PAIRS = frozenset().union(*(pairs(w) for w in re.findall("[a-z]+", IDENTIFIERS.decode())[1:]))
#: Words shorter than any candidate, in lower case but for the first letter.
_ORDINARY = re.compile(r"(?<![\w+/=-])[^\W\d_][^\W\d_A-Z]{1,10}(?![\w+/=-])")
_LETTERS = re.compile(r"[^\W\d_]+")


def novelty(token: str, around: str) -> float:
    """Marginal compressed bytes of ``token``, per character, after ``around`` and the identifiers.

    Each piece is also primed with what stands before it in the token.
    """
    import zstandard

    cost, size = 0, -(-len(token) // -(-len(token) // PIECE))
    for at in range(0, len(token), size):
        seen = f" {around} {token[max(0, at - OWN):at]}" if at else f" {around}"
        primed = zstandard.ZstdCompressor(level=9, write_content_size=False, write_checksum=False, dict_data=zstandard.ZstdCompressionDict(
            IDENTIFIERS + seen.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))
        cost += len(primed.compress(token[at:at + size].encode())) - len(primed.compress(b""))
    return cost / len(token)


def _around(text: str, s: int, e: int, reach: int, around: int) -> str:
    """``around`` code points on either side of the token at ``s:e``, its own copies blanked.

    Copies stay if those on the token's line, itself among them, stand both
    with and without a sensitive word before them: such a string counts as known.
    """
    token, more = text[s:e], around + e - s  # copies that the window cuts are found whole
    left, right = text[max(0, s - more):s], text[e:e + more]
    if token in left or token in right:
        line = left.rsplit("\n", 1)[-1] + token + right.split("\n", 1)[0]
        start = s - len(left.rsplit("\n", 1)[-1])
        copies = [start + m.start() for m in re.finditer(re.escape(token), line)]
        if len({bool(_SENSITIVE.search(text, max(0, at - reach), at)) for at in copies}) < 2:
            blank = " " * len(token)
            left, right = left.replace(token, blank), right.replace(token, blank)
    return left[max(0, len(left) - around):] + " " + right[:around]


def wordy(token: str) -> bool:
    """Whether runs of letters such as words have make up half of the token."""
    return 2 * sum(map(len, _WORDY.findall(token))) >= len(token)


def strangeness(token: str, around: str) -> float:
    """Share of the token's pairs of letters, in any case, that stand in no identifier and in no ordinary word of ``around``."""
    known = _KNOWN_PAIRS.union(*(pairs(w.lower()) for w in _ORDINARY.findall(around)))
    found = [run[i:i + 2].lower() for run in _LETTERS.findall(token) for i in range(len(run) - 1)]
    return sum(p not in known for p in found) / max(len(found), 1)


def candidates(text: str) -> list[tuple[int, int]]:
    """Runs of 12 or more characters that may be a secret, without a sentence's mark or repeated marks around them (8 at least are left).

    What an assignment or a label puts before it (``name=``, ``name:``) is cut
    off. Long parts joined by dots are candidates of their own; words are
    12 characters at least; dates, addresses and other short groups of digits
    are none.
    """
    out = []
    for m in _TOKEN.finditer(text):
        s, e = m.span()
        name = _NAME.match(text, s, e)
        s = _FRONT.match(text, name.end() if name else s, e).end()
        e = s + _BACK.search(text[s:e]).start()
        parts = text[s:e].split(".")
        if len(parts) > 1 and min(map(len, parts)) >= 12:
            for part in parts:
                out.append((s, s + len(part)))
                s += len(part) + 1
        elif e - s >= (12 if wordy(text[s:e]) else 8) and not _NUMBERS.fullmatch(text, s, e):
            out.append((s, e))
    return out


def novel_spans(text: str, base: list[tuple[int, int, str]], least: float, reach: int, around: int) -> list[tuple[int, int, str]]:
    """Tokens in a sensitive context that the primed compressor finds new; ``base`` is sorted by start.

    A token's context is sensitive if a sensitive word stands on its line or
    within ``reach`` of it on either side, or if only marks and space part it
    from a token in such a context (the lines of a key, the parts of a JWT).
    """
    words = [m.span() for m in _SENSITIVE.finditer(text)]
    if not words:
        return []
    begins, ends = [s for s, _ in words], [e for _, e in words]
    breaks = [m.start() for m in re.finditer("\n", text)]
    starts = [s for s, _, _ in base]
    reached = [0, *accumulate((e for _, e, _ in base), max)]  # how far the first k base spans reach
    tokens = candidates(text)
    sensitive = []
    for s, e in tokens:
        line = bisect_left(breaks, s)
        low = min(s - reach, breaks[line - 1] + 1 if line else 0)
        high = max(e + reach, breaks[line] if line < len(breaks) else len(text))
        sensitive.append(bisect_right(ends, high) > bisect_left(begins, low))
    beside = [not _WORDS.search(text, e, s) for (_, e), (s, _) in zip(tokens, tokens[1:])]
    for k in range(len(beside)):
        sensitive[k + 1] |= sensitive[k] and beside[k]
    for k in reversed(range(len(beside))):
        sensitive[k] |= sensitive[k + 1] and beside[k]
    out = []
    for (s, e), near in zip(tokens, sensitive):
        if near and reached[bisect_right(starts, s)] < e:
            seen = _around(text, s, e, reach, around)
            if novelty(text[s:e], seen) >= least and (not wordy(text[s:e]) or strangeness(text[s:e], seen) >= STRANGE):
                out.append((s, e, "novel"))
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, sorted, in code points; an assignment's span is its whole match."""
    found = [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    found += [(*m.span(), "access") for m in _ACCESS.finditer(text)]
    return sorted(found + [(*m.span(), "hex") for m in _HEX.finditer(text)])


def _listed(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]))))


def scan(text: str, least: float = 0.85, reach: int = 64, around: int = 512) -> tuple[int, int, int, str, str]:
    """Counts of the base kinds, SHA-256 of the listed base spans, and all spans listed."""
    base = base_spans(text)
    kinds = [k for _, _, k in base]
    return (kinds.count("assign"), kinds.count("access"), kinds.count("hex"),
            hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(base + novel_spans(text, base, least, reach, around)))


def secret_spans(docs: DataFrame, least: float = 0.85, reach: int = 64, around: int = 512) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every row of ``docs`` (doc_id, text).

    ``least``: novelty from which a token is reported; ``reach``: code points
    on either side of a token in which a sensitive word must stand, unless one
    stands on its line or a token beside it has one; ``around``: code points
    of context on either side that prime the compressor. Null text is
    empty (no spans, digest of the empty string); null and repeated doc_ids
    pass through; other columns are not read; an empty table gives no rows.
    Narrow: no shuffle.
    """
    return per_row(docs.select("doc_id", text_or_empty().alias("text")),
                   lambda: lambda doc_id, text: (doc_id, *scan(text, least, reach, around)), SCHEMA)
