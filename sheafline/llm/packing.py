"""Documents into containers of a fixed number of tokens: sum-of-squares packing.

An item goes where the sum, over all residual gaps, of the squared number of open containers with that gap becomes the
smallest; a new container is one of the choices. This keeps containers of every gap at hand and so closes most of them
exactly full.

Large items come first, so that the small ones are there to close what they leave. The rule is sequential, so it runs within shards of about ``shard_items`` items, whose number follows from a count; an item
is a pair (id, size), never a text. Containers left with more than ``slack`` of their room are taken apart and their items
packed again in fewer shards, until one shard held them all or ``rounds`` are over.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from sheafline.session import cut

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern by which the vocabulary's published tokenizer splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.cache
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding(hashlib.sha1(path.encode()).hexdigest(), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, doc_id: str, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, n_tokens of every row; null and empty texts have 0. ``tokenizer`` is a file of ranks that executors can read."""
    kind = documents.schema[doc_id].dataType.simpleString()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoding(tokenizer).encode_ordinary
        for batch in batches:
            yield pd.DataFrame({"d": batch["d"], "n_tokens": [len(encode(t)) if t else 0 for t in batch["t"]]})

    rows = documents.select(F.col(doc_id).alias("d"), F.col(text).alias("t")).mapInPandas(count, f"d {kind}, n_tokens INT")
    return rows.withColumnRenamed("d", doc_id)


class Packer:
    """Open containers by residual gap; ``place`` gives the number of the container an item goes to."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.gap: list[int] = []

    def place(self, size: int) -> int:
        c, n = self.capacity, self.count
        # Change of the sum of squares for each gap g >= size: the container moves from g to g - size (0: closed).
        after = n[: c + 1 - size]
        change = 2 * (after - n[size:] + 1)
        change[0] = 1 - 2 * n[size]
        change = np.where(n[size:] > 0, change, np.iinfo(np.int64).max)
        fresh = 2 * n[c - size] + 1 if size < c else 0
        g = size + int(change.argmin())
        if change[g - size] < fresh or change[g - size] == fresh and g < c:
            b = self.open[g].pop()
            n[g] -= 1
        else:
            b, g = len(self.gap), c
            self.gap.append(c)
        self.gap[b] = left = g - size
        if left:
            self.open[left].append(b)
            n[left] += 1
        return b


def _packed(items: DataFrame, capacity: int, shards: int, name: str) -> DataFrame:
    """``items`` (item, n_tokens, more columns) with container and the room left in it."""
    schema = T.StructType([*items.schema.fields, T.StructField("container", T.StringType()), T.StructField("room", T.IntegerType())])

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["n_tokens", "order", "item"], ascending=[False, True, True], kind="stable")
        p = Packer(capacity)
        at = np.fromiter((p.place(int(s)) for s in group["n_tokens"]), np.int64, len(group))
        shard = int(group["shard"].iloc[0])
        room = np.array(p.gap, np.int64)[at]
        return group.drop(columns=["order", "shard"]).assign(container=[f"{name}-{shard}-{b}" for b in at], room=room)

    mixed = F.xxhash64("item", F.lit(name))
    return items.withColumns({"order": mixed, "shard": F.pmod(mixed, F.lit(shards)).cast("int")}).groupBy("shard").applyInPandas(pack, schema)


def containers(
    documents: DataFrame, doc_id: str, text: str, capacity: int = 2048, tokenizer: str = TOKENIZER, shard_items: int = 50_000, slack: float = 0.02, rounds: int = 4
) -> DataFrame:
    """doc_id, piece, n_tokens, container of every row of ``documents``.

    A document longer than ``capacity`` is cut into pieces of ``capacity`` tokens and a rest (piece 0, 1, ...), no other is
    ever split. Null and empty texts have 0 tokens and container null. Rows repeating an id are packed each; rows with a
    null id too. An empty table gives no rows. The result depends on ids and sizes only, not on partitions, as long as
    rows of equal id and size are alike.
    """
    sized = cut(token_counts(documents, doc_id, text, tokenizer))
    full = F.when(F.col("n_tokens") > capacity, F.floor(F.col("n_tokens") / capacity)).otherwise(0).cast("int")
    rest = F.col("n_tokens") - full * capacity
    pieces = sized.where("n_tokens > 0").select(
        doc_id, F.explode(F.filter(F.sequence(F.lit(0), full), lambda k: (k < full) | (rest > 0))).alias("piece"), full.alias("full"), rest.alias("rest")
    )
    pieces = pieces.select(doc_id, "piece", F.when(F.col("piece") < F.col("full"), capacity).otherwise(F.col("rest")).cast("int").alias("n_tokens"))
    again = F.row_number().over(Window.partitionBy(doc_id, "piece").orderBy("n_tokens"))  # rows repeating an id
    whole = pieces.where(F.col("n_tokens") == capacity).select(
        doc_id, "piece", "n_tokens", F.concat(F.lit("full-"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("-"), "piece", F.lit("-"), again).alias("container")
    )
    todo = pieces.where(F.col("n_tokens") < capacity).withColumn("item", F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "piece"))
    done = whole
    out = [doc_id, "piece", "n_tokens", "container"]
    for r in range(rounds):
        n = todo.count()
        shards = 1 + (n - 1) // shard_items if n else 1
        packed = cut(_packed(todo, capacity, shards, f"r{r}"))
        last = shards == 1 or r + 1 == rounds
        settled = packed if last else packed.where(F.col("room") <= slack * capacity)
        done = done.unionByName(settled.select(*out))
        if last:
            break
        todo = packed.where(F.col("room") > slack * capacity).drop("container", "room")
    none = sized.where("n_tokens = 0").select(doc_id, F.lit(0).alias("piece"), "n_tokens", F.lit(None).cast("string").alias("container"))
    return done.unionByName(none)
