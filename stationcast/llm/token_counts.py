"""Token counts by a map-side two-tier lookup.

Tier one is a compact table (pre-token -> number of tokens) of the frequent
pre-tokens, made from a bounded sample of documents and broadcast.  Tier two
is a bounded cache in every Python worker that has the tokenizer library
encode the pre-tokens that the table lacks.  No pre-token is ever shuffled.
Both tiers only cache lengths that the library gives, so counts do not depend
on the sample.

The split into pre-tokens follows the byte-level pattern.  It is done here
only for code points below U+0250, where it is tested to agree with the
library.  A pre-token never reaches over a single space that stands between two
other characters, but begins there; so a text with further code points is cut
at such spaces, and only the pieces that hold them go to the library.  Texts
that hold a special token's string go to it whole.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections import Counter
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationcast.llm.common import bounded_sample, map_batches, named, others, workers_ready

#: Documents sampled for the table of frequent pre-tokens, and entries kept (a few MB when broadcast).
SAMPLE_DOCS = 4000
TABLE_SIZE = 100_000
#: Pre-tokens that one worker remembers before it starts its cache anew.
CACHE_SIZE = 400_000
#: Pre-tokens of a very long text that are looked up at once.
CHUNK = 100_000
#: Code points that the split here handles.
SIMPLE_BELOW = 0x250
SIMPLE = re.compile(f"[\\x00-{chr(SIMPLE_BELOW - 1)}]*\\Z")
_ODD = re.compile(f"[^\\x00-{chr(SIMPLE_BELOW - 1)}]+")
#: Places where every pre-token begins anew.
_CUT = re.compile(r"(?<=\S)(?= \S)")


def _chars(category: str) -> str:
    return "".join(re.escape(chr(i)) for i in range(SIMPLE_BELOW) if unicodedata.category(chr(i))[0] == category)


#: The byte-level split (fixed rule of the public vocabulary), with letters and numbers listed:
#: contractions; runs of letters, numbers or other signs with one space before; white space but its last; white space.
_L, _N, _S = _chars("L"), _chars("N"), r"\t-\r \x85\xa0"
_SPLIT = re.compile(rf" ?[{_L}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
#: Bytes as the printable characters that a byte-level vocabulary is written in: printable ones
#: stand for themselves, the others follow from U+0100 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: b if b in _PRINTABLE else 256 + k for b, k in
          ((b, sum(x not in _PRINTABLE for x in range(b))) for b in range(256))}


class PretokenCounter:
    """Counts tokens of texts with a shared table and an own bounded cache."""

    def __init__(self, tokenizer_path: str, table: dict[str, int]):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(tokenizer_path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.table = table
        self.cache: dict[str, int] = {}

    def encode_lengths(self, parts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tok.encode_batch(parts, add_special_tokens=False)]

    def count(self, text: str) -> int:
        if not text:
            return 0
        if any(s in text for s in self.special):
            return self.encode_lengths([text])[0]
        if not SIMPLE.match(text):
            cuts, at, odd, total = [0, *(m.start() for m in _CUT.finditer(text)), len(text)], 0, [], 0
            for m in _ODD.finditer(text):
                if m.start() < at:  # in the piece before
                    continue
                first, last = cuts[bisect_right(cuts, m.start()) - 1], cuts[bisect_left(cuts, m.end())]
                total += self._simple(text[at:first])
                odd.append(text[first:last])
                at = last
            return total + self._simple(text[at:]) + sum(self.encode_lengths(odd))
        return self._simple(text)

    def _simple(self, text: str) -> int:
        if len(text) <= 10 * CHUNK:
            return self._sum(_SPLIT.findall(text))
        found, total = (m.group() for m in _SPLIT.finditer(text)), 0
        while part := list(islice(found, CHUNK)):
            total += self._sum(part)
        return total

    def _sum(self, part: list[str]) -> int:
        lengths = list(map(self.table.get, part))
        if None not in lengths:
            return sum(lengths)
        total = sum(filter(None, lengths))
        for p, n in zip(part, lengths):
            if n is None:
                total += self.cache.get(p) or self._encode(p)
        return total

    def _encode(self, part: str) -> int:
        if len(self.cache) >= CACHE_SIZE:
            self.cache.clear()
        n = self.cache[part] = len(self.tok.model.tokenize(part.encode().decode("latin-1").translate(_BYTES)))
        return n


#: The counter of this worker process, kept over its tasks.
_WORKER: dict[str, object] = {}


def worker_counter(tokenizer_path: str, lengths) -> PretokenCounter:
    table = lengths.value
    if _WORKER.get("path") != tokenizer_path or _WORKER.get("table") is not table:
        _WORKER.update(path=tokenizer_path, table=table, counter=PretokenCounter(tokenizer_path, table))
    return _WORKER["counter"]


def frequent_lengths(docs: DataFrame, text: str, key: str, tokenizer_path: str,
                     sample_docs: int = SAMPLE_DOCS, size: int = TABLE_SIZE) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of a bounded sample of documents."""
    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen: Counter = Counter()
        for t in batch.column(0).to_pylist():
            if t and SIMPLE.match(t):
                seen.update(_SPLIT.findall(t))
        top = seen.most_common(size)
        return pa.RecordBatch.from_pydict({"p": pa.array([p for p, _ in top], pa.string()),
                                           "n": pa.array([n for _, n in top], pa.int64())})
    some = bounded_sample(docs.select(named(key)[0].alias("k"), named(text)[0].alias("t")), "k", sample_docs).select("t")
    top = (map_batches(some, count, "p string, n long").groupBy("p").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "p").limit(size).select("p").collect())  # at most ``size`` short strings
    parts = [r["p"] for r in top]
    return dict(zip(parts, PretokenCounter(tokenizer_path, {}).encode_lengths(parts))) if parts else {}


def count_tokens(docs: DataFrame, tokenizer_path: str, text: str = "text", key: str = "doc_id",
                 out: str = "n_tokens", sample_docs: int = SAMPLE_DOCS, table_size: int = TABLE_SIZE) -> DataFrame:
    """``docs`` with the column ``out`` (long): tokens of the whole text as the
    library counts them, without added special tokens.

    Null and empty texts count 0.  Columns of ``docs`` that are called like the
    result are replaced; others, repeated rows and null keys stay as they are.
    An empty table gives an empty result."""
    spark = docs.sparkSession
    lengths = spark.sparkContext.broadcast(frequent_lengths(docs, text, key, tokenizer_path, sample_docs, table_size))

    @F.pandas_udf("long")
    def tokens(texts):
        counter = worker_counter(tokenizer_path, lengths)
        return texts.map(lambda t: counter.count(t) if isinstance(t, str) else 0).astype("int64")
    workers_ready(spark)
    return docs.select(*named(*others(docs, out)), tokens(named(text)[0]).alias(out))


def digest(docs: DataFrame, tokenizer_path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit for every document."""
    def length(c: Column) -> Column:
        return F.coalesce(F.octet_length(c), F.lit(0)).cast("long")
    return (count_tokens(docs.select("doc_id", "text"), tokenizer_path)
            .select("doc_id", length(F.col("text")).alias("n_bytes"), "n_tokens",
                    (F.col("n_tokens") > limit).alias("over_limit")))
