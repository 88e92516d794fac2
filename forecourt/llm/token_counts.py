"""Token counts by a two-tier lookup beside the documents.

A byte-level tokenizer cuts a text into pre-tokens and encodes each by itself, so a document's count is a sum over
its pre-tokens. First tier: a compact table with the token counts of the corpus's most frequent pre-tokens, sent to
every task. Second tier: a cache in each Python worker; only a pre-token that neither knows is encoded. No
pre-token is shuffled.

The table comes from every document: each task keeps a mergeable frequency summary (Misra-Gries: when it outgrows
its capacity, the count just below the capacity is taken off all), and summaries are merged in a tree. Its size is
fixed by ``capacity``, so what is broadcast does not grow with the corpus. The table only decides what is looked
up where; counts never depend on it.

Defined results: a null text is empty and has 0 tokens; special strings inside a text count as the tokenizer counts
them by default; repeated rows each get their count; other columns pass through, an existing count column is replaced.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.llm.common import documents, drop_names, hold

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 1 << 16  # entries of the broadcast table and of each task's summary
CACHE = 1 << 19  # entries a worker's cache may hold before it starts anew
SLICE = 256  # documents handled at a time
LIMIT = 1024  # tokens a document may have before it is over the limit

# Letters, numbers and blanks among the characters below, as the tokenizer's pattern has them.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", "\\t-\\r \x85\xa0"
_PLAIN = re.compile("[\\x00-ɏ‐-‧€]*")
_PRE_TOKEN = re.compile(f" ?[{_L}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


def tokenizer_path(name: str) -> str:
    """A path as it is, or the place of one of the public vocabulary files."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class PreTokens:
    """Pre-tokens of texts, and the number of tokens of each; one per worker and tokenizer."""

    def __init__(self, name: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        added = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, added))) if added else None
        self.cache: dict[str, int] = {}

    def split(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens, and how many special strings stood between them."""
        if self.special is not None and self.special.search(text):
            parts = self.special.split(text)
            return list(chain.from_iterable(map(self.plain, parts))), len(parts) - 1
        return self.plain(text), 0

    def plain(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text):
            return _PRE_TOKEN.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def encode(self, words: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def counts(self, texts: list[str], frequent: dict[str, int]) -> list[int]:
        """The number of tokens of each text."""
        totals, missed = [], []
        for text in texts:
            words, special = self.split(text)
            known = list(map(frequent.get, words))
            totals.append(special + sum(filter(None, known)))
            missed.append([w for w, n in zip(words, known, strict=True) if n is None] if None in known else [])
        unknown = set(chain.from_iterable(missed)).difference(self.cache)
        if len(self.cache) + len(unknown) > CACHE:
            self.cache.clear()
            unknown = set(chain.from_iterable(missed))
        new = list(unknown)
        self.cache.update(zip(new, self.encode(new), strict=True))
        return [n + sum(map(self.cache.__getitem__, words)) for n, words in zip(totals, missed, strict=True)]


@lru_cache(maxsize=1)
def _pre_tokens(name: str) -> PreTokens:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core already
    return PreTokens(name)


def pre_tokens(name: str) -> PreTokens:
    hold("token counts", _pre_tokens.cache_clear)
    return _pre_tokens(name)


def texts_of(column: pa.Array) -> list[str]:
    return ["" if t is None else t for t in column.to_pylist()]


def pruned(counts: Counter, capacity: int) -> Counter:
    """A Misra-Gries summary of at most ``capacity`` entries; it misses no count by more than total / capacity."""
    if len(counts) <= capacity:
        return counts
    off = sorted(counts.values(), reverse=True)[capacity]
    return Counter({w: n - off for w, n in counts.items() if n > off})


def frequent_pre_tokens(docs: DataFrame, text_col: str = "text", tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> dict[str, int]:
    """Token counts of the most frequent pre-tokens over all documents, at most ``capacity`` of them."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, counts = pre_tokens(tokenizer).split, Counter()
        for batch in batches:
            for text in texts_of(batch.column(0)):
                counts.update(split(text)[0])
                if len(counts) > 4 * capacity:
                    counts = pruned(counts, capacity)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(dict(pruned(counts, capacity)))], pa.binary())], ["s"])

    def merge(a: dict[str, int], b: dict[str, int]) -> dict[str, int]:
        merged = Counter(a)
        merged.update(b)
        return dict(pruned(merged, capacity))

    summaries = docs.select(F.col(f"`{text_col}`")).mapInArrow(summarise, "s binary")
    words = list(summaries.rdd.map(lambda row: pickle.loads(row.s)).treeReduce(merge, 3)) if summaries.rdd.getNumPartitions() else []
    return dict(zip(words, pre_tokens(tokenizer).encode(words), strict=True))


def count_tokens(docs: DataFrame, text_col: str = "text", out_col: str = "n_tokens", tokenizer: str = TOKENIZER, capacity: int = CAPACITY, keep_text: bool = True) -> DataFrame:
    """``docs`` with the number of tokens of each text, without begin, end or padding tokens.

    Without ``keep_text`` the text column goes, which spares sending it back from the Python workers.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequent_pre_tokens(docs, text_col, tokenizer, capacity))
    docs = drop_names(docs, out_col)
    at = docs.columns.index(text_col)
    kept = [i for i in range(len(docs.columns)) if keep_text or i != at]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, worker = table.value, pre_tokens(tokenizer)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                totals = worker.counts(texts_of(part.column(at)), frequent)
                columns = [*(part.column(i) for i in kept), pa.array(totals, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    schema = T.StructType([*(docs.schema.fields[i] for i in kept), T.StructField(out_col, T.LongType())])
    return docs.mapInArrow(count, schema)


def q_token_counts(spark, sf_dir):
    """Bytes and tokens of every document, and whether it has more than 1024 tokens."""
    docs = documents(spark, sf_dir).select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    )
    return count_tokens(docs, keep_text=False).select(
        "doc_id",
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > LIMIT).alias("over_limit"),
    )
