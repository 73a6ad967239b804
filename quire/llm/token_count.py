"""Token counts of a piece-based BPE model, without producing identifiers.

A text's characters (a space is the piece mark U+2581) are linked symbols; the
adjacent pair of the best-ranked piece is popped from a heap, merged, and the
pairs with the new neighbours are pushed. The count is the initial symbols less
the merges, plus the further bytes of characters that the model spells in bytes.

No piece holds a mark behind another character (checked when the model is
read), and a line feed is in no longer piece, so texts are cut there and the
count of each cut is kept in a bounded memo per Python worker.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.textarrays import text_column

MARK = "▁"
MEMO_ENTRIES = 400_000


class PieceCounter:
    """Counts of one model; ``path`` names its file, present on each executor."""

    def __init__(self, path: str, memo_entries: int = MEMO_ENTRIES):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.rank = {sp.id_to_piece(i): -sp.get_score(i) for i in normal}
        longer = [p for p in self.rank if len(p) > 1]
        if any(MARK in p.lstrip(MARK) for p in longer):
            raise ValueError("a piece holds a space mark behind another character")
        cut_lf = not any("\n" in p for p in longer)
        self.cuts = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n" if cut_lf else f"{MARK}*[^{MARK}]+|{MARK}+").findall
        self.memo: dict[str, int] = {}
        self.memo_entries = memo_entries

    def merged(self, s: str) -> int:
        """Tokens of one cut."""
        rank, n = self.rank, len(s)
        count = n + sum(len(c.encode()) - 1 for c in s if c not in rank)
        if n < 2:
            return count
        end = list(range(1, n + 1))  # of the symbol that begins here; 0: merged away
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(s[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, e = heapq.heappop(heap)
            if not end[i] or (j := nxt[i]) >= n or end[j] != e:
                continue
            count -= 1
            end[i], end[j] = e, 0
            k = nxt[i] = nxt[j]
            if k < n:
                prv[k] = i
                if (r := rank.get(s[i : end[k]])) is not None:
                    heapq.heappush(heap, (r, i, end[k]))
            if (h := prv[i]) >= 0 and (r := rank.get(s[h:e])) is not None:
                heapq.heappush(heap, (r, h, e))
        return count

    def count(self, text: str) -> int:
        if not text:
            return 0
        cuts = self.cuts(MARK + text.replace(" ", MARK))
        memo = self.memo
        try:
            return sum(map(memo.__getitem__, cuts))
        except KeyError:
            if len(memo) > self.memo_entries:
                memo.clear()
            total = 0
            for c in cuts:
                n = memo.get(c)
                if n is None:
                    n = self.merged(c)
                    if len(c) <= 64:
                        memo[c] = n
                total += n
            return total


_COUNTERS: dict[str, PieceCounter] = {}


def counter(path: str) -> PieceCounter:
    """The worker's counter of a model, kept between tasks."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PieceCounter(path)
    return _COUNTERS[path]


def token_counts(
    docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of each row.

    Null and empty texts have 0 bytes and 0 tokens; a text is never cut short;
    repeated rows and ids give repeated results; an empty table gives none.
    Only the id and text columns are read, so others can't clash.
    """
    text: Column = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(model_path)
        for b in batches:
            n = [model.count(t.as_py()) for t in text_column(b.column(2))]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(n, pa.int64())], names=[id_col, "n_bytes", "n_tokens"])

    src = docs.select(F.col(id_col), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("t"))
    kind = src.schema[0].dataType.simpleString()
    out = src.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
