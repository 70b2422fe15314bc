"""Token counts by heap-and-linked-list byte-pair merging (operator 2).

Each pre-token starts as a doubly linked list of byte symbols. A heap holds the
adjacent pairs by merge rank and position; the lowest is popped and merged until
no ranked pair is left. The count is the initial symbols less the merges: no
token identifier is ever formed.

Null text counts as empty: 0 bytes, 0 tokens. Texts of any length are counted
whole; only counts of short pieces are remembered. Equal ranks fall to the pair
further left. Repeated rows each get a row, and an empty table none. Columns other
than the id and the text are neither read nor returned, so their names can't
clash.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import chunks
from corpusloom.llm.storage import ship_package

#: Fixed value: the published pre-tokenizer pattern of the byte-level vocabulary.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=1)
def pretoken_patterns() -> tuple[regex.Pattern, regex.Pattern, frozenset[str]]:
    """The published pattern, the pattern with letters and numbers as the tokenizers library knows them, and the characters on which they differ.

    Leaving these out one by one makes a pattern several times as slow, so it is for the texts that hold one.

    The installed regex may follow a later Unicode version. What it takes for a
    letter or a number and Python's own, earlier tables do not is asked of the library.
    """
    from tokenizers import pre_tokenizers

    split, pattern, differ = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True), PRETOKEN, set()
    for kind, like in (("L", "a"), ("N", "1")):
        known = regex.compile(rf"\p{{{kind}}}")
        late = (c for c in map(chr, (*range(0xD800), *range(0xE000, 0x110000))) if unicodedata.category(c)[0] != kind and known.match(c))
        if odd := [c for c in late if len(split.pre_tokenize_str(like + c + like)) > 1]:
            differ |= set(odd)
            pattern = pattern.replace(rf"\p{{{kind}}}", rf"[\p{{{kind}}}--[{''.join(map(regex.escape, odd))}]]")
    return regex.compile(PRETOKEN), regex.compile(pattern, regex.V1), frozenset(differ)


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class MergeCounter:
    """Counts a text's tokens under a ranked merge list."""

    def __init__(self, ranks: dict[tuple[str, str], int], special: list[str], bound: int = 500_000):
        self.ranks = ranks
        self.symbols = byte_symbols()
        self.published, self.exact, self.odd = pretoken_patterns()
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.words = chunks.Memo(self.merged_length, bound)
        self.plain = chunks.Memo(self.piece, bound)
        self.spaced = chunks.Memo(lambda piece: self.piece(" " + piece), bound)

    @classmethod
    def from_file(cls, path: str) -> MergeCounter:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        odd = [t for t in spec["added_tokens"] if t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]]
        if odd or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{path}: only plain byte-level vocabularies are handled")
        return cls({m: rank for rank, m in enumerate(merges)}, [t["content"] for t in spec["added_tokens"]])

    def merged_length(self, word: str) -> int:
        symbols = [self.symbols[b] for b in word.encode("utf-8")]
        n = len(symbols)
        if n < 2:
            return n
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        rank_of = self.ranks.get
        heap = [rank << 40 | i for i in range(n - 1) if (rank := rank_of((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        merges = 0
        while heap:
            entry = heapq.heappop(heap)
            i, rank = entry & 0xFFFFFFFFFF, entry >> 40
            left, j = symbols[i], after[i]
            if left is None or j >= n or rank_of((left, symbols[j])) != rank:
                continue  # one of its symbols has been merged since
            symbols[i], symbols[j] = left + symbols[j], None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (rank := rank_of((symbols[i], symbols[k]))) is not None:
                    heapq.heappush(heap, rank << 40 | i)
            if (h := before[i]) >= 0 and (rank := rank_of((symbols[h], symbols[i]))) is not None:
                heapq.heappush(heap, rank << 40 | h)
            merges += 1
        return n - merges

    def piece(self, text: str) -> int:
        """Tokens of a text that is counted by itself; special strings are one token each."""
        found = self.special.findall(text) if self.special else ()
        parts = self.special.split(text) if found else (text,)
        pretoken = self.published if text.isascii() or self.odd.isdisjoint(text) else self.exact
        return len(found) + sum(self.words[w] for part in parts for w in pretoken.findall(part))

    def count(self, text: str) -> int:
        total = -1
        for line in chunks.lines(text):
            first, *rest = chunks.pieces(line)
            total += 1 + self.plain[first] + sum(map(self.spaced.__getitem__, rest))
        return total


@lru_cache(maxsize=2)
def counter(path: str) -> MergeCounter:
    """One per Python worker, so that cached words outlive a task."""
    return MergeCounter.from_file(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, limit: int = 512) -> DataFrame:
    """Per row: the id, UTF-8 bytes, tokens, and whether the tokens exceed the limit.

    vocabulary: path of a byte-level BPE .json that every executor can read;
    None takes the installed public vocabulary on each executor.
    """
    ship_package(docs.sparkSession)
    ids = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    schema = T.StructType([docs.schema[id_col], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def count(batches):
        bpe = counter(vocabulary or default_vocabulary())
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = [bpe.count(t) for t in texts]
            sizes = [len(t.encode("utf-8")) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())], names=schema.names)

    return ids.mapInArrow(count, schema)
