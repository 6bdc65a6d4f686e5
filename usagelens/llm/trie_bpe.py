"""BPE encoding and decoding by traversal of a prefix-sharing trie.

The last token of a prefix's encoding is the one vocabulary entry that ends
the prefix and fits behind the last token of what stands before it; two
tokens fit if their joined symbols encode to just these two. The distinct
words of a batch are walked in sorted order, which is the depth-first order
of their trie, with the last-token state of every node on the current path:
what two words share at the front is computed once. A word's last symbol
carries the end-of-word mark, so its end is a leaf of its own. Walking the
states back from the leaf gives the tokens.
"""
from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import regex
from pyspark.sql import DataFrame

from usagelens.llm.common import chunks, per_row, per_worker, text_or_empty

REMEMBERED = 300_000
#: Pieces of more characters are not remembered, which bounds the cache in bytes.
LONGEST = 64
PAIRS_REMEMBERED = 300_000
CHUNK = 1 << 19
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: White space as the regular expressions of the tokenizer file see it.
_WHITE = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


#: The one split pattern of word-level BPE files known here (a fixed value), and the same for texts of plain letters.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN_WORDS = re.compile(r"[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)|\d|(?:[^\w\s]|_)+").findall
_WORDS = regex.compile(r"\p{L}+|'(?:s|t|re|ve|m|ll|d)|\p{N}|[^\s\p{L}\p{N}]+").findall
_NOT_PLAIN = re.compile("[^\t-\r -~\xc0-\xd6\xd8-\xf6\xf8-\u017f]").search


def _lowered(text: str) -> str:
    """Composed and in lower case, letter by letter (no context rule for the final sigma)."""
    return _WHITE.sub(" ", unicodedata.normalize("NFC", text)).replace("Σ", "σ").lower()


class Cache(dict):
    """Encodings by piece; those beyond the bound live in ``extra`` until the next batch."""

    extra: dict[str, tuple[str, str]] = {}

    def __missing__(self, piece: str) -> tuple[str, str]:
        return self.extra[piece]


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte (byte-level BPE)."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    extra = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of one word-level BPE file (JSON)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if (model["type"] != "BPE" or not model["end_of_word_suffix"] or model["continuing_subword_prefix"]
                or kinds != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed" or not split["invert"]
                or split["pattern"]["Regex"] != _PATTERN or spec["decoder"] or spec["post_processor"] or any(t["normalized"] for t in spec["added_tokens"])):
            raise ValueError(f"{path}: not a word-level BPE file of the supported kind")
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.rank = {tuple(m): i for i, m in enumerate(model["merges"])}
        inner = [t for t in self.ids if not t.endswith(self.end)]
        self.longest = max(map(len, inner)), max(len(t) - len(self.end) for t in self.ids if t.endswith(self.end))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else lambda t: [t]
        self.token = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.symbol = byte_symbols()
        self.fits_cache: dict[tuple[str, str], bool] = {}
        self.cache = Cache()

    # ---- pairs of tokens
    def symbols(self, token: str) -> list[str]:
        if token.endswith(self.end):
            body = token[:-len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def merged(self, symbols: list[str]) -> list[str]:
        """Plain merging of a short symbol list, lowest rank and leftmost first."""
        parts, rank, far = list(symbols), self.rank, len(self.rank)
        while len(parts) > 1:
            r, i = min((rank.get((a, b), far), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if r == far:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def fits(self, last: str, token: str) -> bool:
        """Whether ``token`` follows ``last`` in an encoding ("" at the start of a word)."""
        known = self.fits_cache.get((last, token))
        if known is None:
            known = self.merged([*self.symbols(last), *self.symbols(token)] if last else self.symbols(token)) == (
                [last, token] if last else [token])
            if len(self.fits_cache) < PAIRS_REMEMBERED:
                self.fits_cache[last, token] = known
        return known

    # ---- the trie walk
    def _last(self, word: str, depth: int, states: list[str], mark: str, longest: int) -> str:
        """Last token of the node ``word[:depth]``, whose ancestors' last tokens are ``states``."""
        ids = self.ids
        for n in range(min(depth, longest), 0, -1):
            token = word[depth - n:depth] + mark
            if token in ids and (self.fits(states[depth - n], token)):
                return token
        raise ValueError(f"no token ends {word[:depth]!r}")

    def walk(self, words: Iterable[str]) -> Iterator[tuple[str, list[str]]]:
        """(word, tokens) for words of byte symbols, in the depth-first order of their trie."""
        states, above = [""], ""  # states[d]: last token of the node at depth d on the path
        for word in sorted(words):
            shared = 0
            for a, b in zip(above, word):
                if a != b:
                    break
                shared += 1
            del states[min(shared, len(word) - 1) + 1:]
            for depth in range(len(states), len(word)):
                states.append(self._last(word, depth, states, "", self.longest[0]))
            token = self._last(word, len(word), states, self.end, self.longest[1])
            tokens, at = [token], len(word) - len(token) + len(self.end)
            while at:
                tokens.append(states[at])
                at -= len(states[at])
            above = word
            yield word, tokens[::-1]

    # ---- texts
    def pieces(self, text: str) -> list[str]:
        """Words and special strings of a text, in order."""
        out: list[str] = []
        for part in self.cut_special(text):
            if part in self.special:
                out.append(part)
            elif not _NOT_PLAIN(part):  # composed letters of Latin scripts, no other white space or numbers
                out += _PLAIN_WORDS(part.lower()) if unicodedata.is_normalized("NFC", part) else _WORDS(_lowered(part))
            else:
                out += _WORDS(_lowered(part))
        return out

    def encodings(self, pieces: list[str]) -> list[tuple[str, str]]:
        """(ids joined by spaces, tokens joined by spaces) of every piece."""
        known, new = self.cache, {}
        symbol, ids = self.symbol, self.ids
        missing = {p for p in set(pieces) if p not in known}
        back = {"".join([symbol[b] for b in p.encode()]): p for p in missing if p not in self.special}
        for word, tokens in self.walk(back):
            new[back[word]] = " ".join([str(ids[t]) for t in tokens]), " ".join(tokens)
        for s in missing.intersection(self.special):
            new[s] = str(self.special[s]), s
        for p, found in new.items():
            if len(known) >= REMEMBERED:
                break
            if len(p) <= LONGEST:
                known[p] = found
        known.extra = new
        return list(map(known.__getitem__, pieces))

    def encode(self, text: str) -> list[int]:
        return [int(i) for ids, _ in self.encodings(self.pieces(text)) for i in ids.split(" ")]

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens joined by one space: the file names no decoder."""
        return " ".join(self.token[i] for i in ids if i in self.token)

    def digest(self, text: str) -> tuple[int, str, str]:
        """Token count, SHA-256 of the ids, SHA-256 of the decoded text, in bounded memory."""
        ids, decoded, n, gap = hashlib.sha256(), hashlib.sha256(), 0, ""
        for part in chunks(text, CHUNK):
            found = self.encodings(self.pieces(part))
            if found:
                coded, tokens = zip(*found)
                line = " ".join(coded)
                ids.update((gap + line).encode())
                decoded.update((gap + " ".join(tokens)).encode())
                n += line.count(" ") + 1
                gap = " "
        return n, ids.hexdigest(), decoded.hexdigest()


def word_bpe(path: str) -> WordBpe:
    return per_worker(WordBpe, path)


def bpe_round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode every text: (doc_id, n_tokens, ids_sha256, decoded_sha256), a row per row.

    ``path`` names a word-level BPE file that every executor can read. Null
    text counts as empty (no tokens, digests of the empty string); null and
    repeated doc_ids pass through; other columns are not read; an empty table
    gives no rows. Narrow: no shuffle.
    """
    def make():
        digest = word_bpe(path).digest
        return lambda doc_id, text: (doc_id, *digest(text))

    return per_row(docs.select("doc_id", text_or_empty().alias("text")), make, SCHEMA)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>) of every row; same rules as :func:`bpe_round_trip`."""
    def make():
        encoder = word_bpe(path)
        return lambda doc_id, text: (doc_id, encoder.encode(text))

    return per_row(docs.select("doc_id", text_or_empty().alias("text")), make, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); a null list gives the empty text, unknown ids are skipped."""
    def make():
        decoder = word_bpe(path)
        return lambda doc_id, ids: (doc_id, decoder.decode(ids or []))

    return per_row(encoded.select("doc_id", "ids"), make, "doc_id long, text string")
