"""Token counts through a digest cache.

A text is looked up by the digest of its normalised content and the digest of the tokenizer's file. Only distinct texts
that the cache doesn't know are encoded; their counts are appended to it.
"""

import hashlib
import json
import re

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from retailoom.llm.store import Scratch

CACHE_SCHEMA = "content string, tokenizer string, n_tokens long"

# fixed value: how byte-level vocabularies split text
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# tiktoken's regex gives up on a run of about a million white-space characters
SAFE_RUN = 100_000


def byte_characters() -> dict[str, int]:
    """The printable characters that byte-level vocabularies write for the 256 bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class TokenCounter:
    """Counts tokens as the ``tokenizers`` library does without added special tokens.

    A plain byte-level vocabulary whose ids follow its merges is counted with ``tiktoken``, which gives the same counts
    several times faster; any other file goes to ``tokenizers`` itself, and so does a text with a run of more than
    ``SAFE_RUN`` white-space characters. Strings of special tokens inside a text count as
    the one token they are.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.fast = self._plain(spec)

    @staticmethod
    def _plain(spec: dict) -> tiktoken.Encoding | None:
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (
            model.get("type") == "BPE"
            and before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space")
            and before.get("use_regex", True)
            and not spec.get("normalizer")
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges"))
            and all(t["special"] and not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in spec.get("added_tokens", []))
        )
        special = {t["content"] for t in spec.get("added_tokens", [])}
        if not plain or len(special) > 1:
            return None
        as_byte = byte_characters()
        vocabulary = {word: i for word, i in model["vocab"].items() if word not in special}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ids = [vocabulary.get(a + b, -1) for a, b in merges]
        if ids != sorted(ids) or len(vocabulary) != 256 + len(ids) or any(c not in as_byte for word in vocabulary for c in word):
            return None
        ranks = {bytes(as_byte[c] for c in word): i for word, i in vocabulary.items()}
        return tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def count(self, text: str) -> int:
        if self.fast is None:
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        parts = text.split(self.special[0]) if self.special else [text]
        return len(parts) - 1 + sum(map(self._count_part, filter(None, parts)))

    def _count_part(self, text: str) -> int:
        if len(text) > SAFE_RUN and any(run.end() - run.start() > SAFE_RUN for run in re.finditer(r"\s+", text)):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return len(self.fast.encode_ordinary(text))


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def _cache(spark: SparkSession, folder: str) -> DataFrame:
    """The stored counts; an empty table before the first append."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    there = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    return spark.read.schema(CACHE_SCHEMA).parquet(folder) if there else spark.createDataFrame([], CACHE_SCHEMA)


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    cache: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = 512,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; ``tokenizer`` is a file that all machines have at this path.

    ``cache`` is a Parquet folder of (content, tokenizer, n_tokens); None takes a new one below the shared folder. Only
    contents it lacks are encoded, each once however often it occurs, and appended with one write: a failed run appends
    nothing. Null counts as the empty text, which has 0 tokens. Rows are judged one by one: repeats come out repeated.
    An empty table appends nothing.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "tokens")
    cache = cache or f"{scratch.folder}/cache"
    version = tokenizer_digest(tokenizer)
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    content = F.sha2(text, 256)
    known = _cache(spark, cache).where(F.col("tokenizer") == version).select("content", "n_tokens")
    rows = docs.select(F.col(id_column).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), content.alias("content"))
    # copies of a text meet on the map side first, so a hot text is shuffled once per task
    distinct = docs.select(content.alias("content"), text.alias("text")).groupBy("content").agg(F.first("text").alias("text"))
    missing = distinct.join(known, "content", "left_anti")

    def encode(batches):
        counter = TokenCounter(tokenizer)
        for batch in batches:
            counts = pa.array([counter.count(t) for t in batch.column(1).to_pylist()], pa.int64())
            yield pa.record_batch([batch.column(0), pa.array([version] * batch.num_rows, pa.string()), counts], ["content", "tokenizer", "n_tokens"])

    missing.mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(cache)
    counted = _cache(spark, cache).where(F.col("tokenizer") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    return rows.join(counted, "content", "left").select(
        F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
