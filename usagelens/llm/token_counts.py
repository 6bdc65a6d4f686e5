"""Token counts by heap-and-linked-list byte-pair merging.

The text is split where no merge can reach (before every run of spaces and
around line feeds, provided the vocabulary has no piece that spans such a
place). Within one stretch the adjacent pairs wait in a heap by rank, the
symbols stand in a doubly linked list, and the pair of lowest rank (leftmost
of equals) is merged until none is left. The count is the number of initial
symbols minus the merges; a symbol that stays outside the vocabulary counts
its UTF-8 bytes (byte fallback). No identifier is produced.
"""
from __future__ import annotations

import re
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame

from usagelens.llm.common import chunks, per_row, per_worker, text_or_empty

SPACE = "▁"
#: Stretches remembered per Python worker; later ones are counted anew each time.
REMEMBERED = 400_000
#: Stretches of more characters are not remembered, which bounds the cache in bytes.
LONGEST = 64
CHUNK = 1 << 20
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def count_merged(symbols: str, rank: dict[str, int]) -> int:
    """Tokens of one stretch after all merges, lowest rank first."""
    parts: list[str] = list(symbols)
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(rank[p], i, p) for i in range(n - 1) if (p := parts[i] + parts[i + 1]) in rank]
    heapify(heap)
    count = n
    while heap:
        _, i, piece = heappop(heap)
        j = after[i]
        if j >= n or not parts[i] or parts[i] + parts[j] != piece:
            continue  # one of the two has been merged since
        parts[i], parts[j] = piece, ""
        count -= 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (p := piece + parts[k]) in rank:
                heappush(heap, (rank[p], i, p))
        h = before[i]
        if h >= 0 and (p := parts[h] + piece) in rank:
            heappush(heap, (rank[p], h, p))
    return count + sum(len(p.encode()) - 1 for p in parts if p and p not in rank)


class PieceCounter(dict):
    """Counts by stretch for one vocabulary file, remembered up to ``limit`` stretches."""

    def __init__(self, path: str, limit: int = REMEMBERED):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, norm = model.trainer_spec, model.normalizer_spec
        if (spec.model_type != spec.BPE or not spec.byte_fallback or norm.precompiled_charsmap
                or norm.remove_extra_whitespaces or not norm.escape_whitespaces or not norm.add_dummy_prefix
                or any(p.type in (p.USER_DEFINED, p.UNUSED) for p in model.pieces)):
            raise ValueError(f"{path}: only plain BPE pieces with byte fallback and untouched text are supported")
        normal = [p for p in model.pieces if p.type == p.NORMAL]
        # scores fall from piece to piece: the first has the lowest rank
        self.rank = {p.piece: i for i, p in enumerate(sorted(normal, key=lambda p: -p.score))}
        inner = any(SPACE in p.lstrip(SPACE) for p in self.rank)
        lines = any("\n" in p for p in self.rank)
        self.stretch = re.compile("(?s).+" if inner or lines else f"[ {SPACE}]*[^ {SPACE}\n]+|[ {SPACE}]+|\n").findall
        self.whole = inner or lines
        self.limit = limit

    def __missing__(self, stretch: str) -> int:
        n = count_merged(stretch.replace(" ", SPACE), self.rank)
        if len(self) < self.limit and len(stretch) <= LONGEST:
            self[stretch] = n
        return n

    def count(self, text: str) -> int:
        """Tokens of a whole text; empty: 0."""
        if not text:
            return 0
        parts = [" " + text] if self.whole else chunks(" " + text, CHUNK)
        return sum(sum(map(self.__getitem__, self.stretch(p))) for p in parts)


def counter(path: str) -> PieceCounter:
    return per_worker(PieceCounter, path)


def token_counts(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """One row (doc_id, n_bytes, n_tokens, over_limit) per row of ``docs`` (doc_id, text).

    ``path`` is a sentencepiece BPE file that every executor can read. Null
    text counts as empty (0 tokens); null and repeated doc_ids pass through,
    a row each; other columns are not read; an empty table gives no rows.
    Narrow: no shuffle. Memory: one piece of text plus a bounded cache.
    """
    def make():
        count = counter(path).count

        def row(doc_id, text):
            n = count(text)
            return doc_id, len(text.encode()), n, n > limit
        return row

    return per_row(docs.select("doc_id", text_or_empty().alias("text")), make, SCHEMA)
