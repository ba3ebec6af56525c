"""Best-fit packing of documents into sequences of fixed length, under conflicts.

Two documents of one source, or of one duplicate cluster, never share a bin. A
bin is known by its residual and a bitmap of the sources and clusters it holds.
Open bins are kept in order of residual; a document goes to the tightest bin
whose bitmap does not meet its own. The successor search goes on from the first
residual that fits until such a bin is found, and opens a new one otherwise.

Documents are dealt to shards by their hash, so every shard has about the same
number of documents whatever the sources; a shard is packed by one task, and
the number of shards follows the number of documents.
"""

from __future__ import annotations

import bisect

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.llm.nearcopies import near_copies, sketched
from stockweave.session import materialize

CAPACITY = 2048
SHARD_DOCS = 4096
BYTES_PER_TOKEN = 4


class OpenBins:
    """Open bins by residual, and within one residual by bitmap.

    Bins with the same residual and bitmap are alike, so a search looks at each
    kind once: a hot source costs one look per residual, not one per bin.
    """

    def __init__(self) -> None:
        self.residuals: list[int] = []  # ascending, those with an open bin
        self.kinds: dict[int, dict[int, list[int]]] = {}

    def add(self, residual: int, bitmap: int, bin_id: int) -> None:
        if residual <= 0:
            return
        kinds = self.kinds.get(residual)
        if kinds is None:
            kinds = self.kinds[residual] = {}
            bisect.insort(self.residuals, residual)
        kinds.setdefault(bitmap, []).append(bin_id)

    def take(self, size: int, bitmap: int) -> tuple[int, int, int] | None:
        """(residual, bitmap, bin) of the tightest compatible bin, removed from here."""
        for at in range(bisect.bisect_left(self.residuals, size), len(self.residuals)):
            residual = self.residuals[at]
            kinds = self.kinds[residual]
            found = next((k for k in kinds if not k & bitmap), None)
            if found is None:
                continue
            bins = kinds[found]
            bin_id = bins.pop()
            if not bins:
                del kinds[found]
                if not kinds:
                    del self.kinds[residual]
                    del self.residuals[at]
            return residual, found, bin_id
        return None


def best_fit(pieces: list[tuple[int, int, int]], capacity: int) -> list[int]:
    """Bin of every piece; pieces are (size, source, cluster) in packing order.

    Sources and clusters are small numbers, -1 for none. Sizes are at most the
    capacity. A piece of the full capacity, and one of size 0 or less that no
    open bin takes, gets a bin of its own.
    """
    shift = max([0, *(s + 1 for _, s, _ in pieces)])
    open_bins, bins, made = OpenBins(), [], 0
    for size, source, cluster in pieces:
        bitmap = (1 << source if source >= 0 else 0) | (
            1 << (shift + cluster) if cluster >= 0 else 0
        )
        found = open_bins.take(max(1, size), bitmap) if size < capacity else None
        if found is None:
            residual, held, bin_id = capacity, 0, made
            made += 1
        else:
            residual, held, bin_id = found
        bins.append(bin_id)
        open_bins.add(residual - max(1, size), held | bitmap, bin_id)
    return bins


def _pack_shard(group: pa.Table, capacity: int) -> pa.Table:
    rows = group.select(["size", "key", "part", "source", "cluster"]).to_pylist()

    def place(i: int) -> tuple:
        r = rows[i]
        return -r["size"], r["key"], r["part"], r["source"] or "", r["source"] is None

    order = sorted(range(len(rows)), key=place)
    counts: dict = {}
    for r in rows:
        counts[r["cluster"]] = counts.get(r["cluster"], 0) + 1
    sources: dict = {}
    clusters: dict = {}
    pieces = []
    for i in order:
        r = rows[i]
        source = -1 if r["source"] is None else sources.setdefault(r["source"], len(sources))
        # a cluster met once in the shard cannot conflict
        alone = r["cluster"] is None or counts[r["cluster"]] == 1
        cluster = -1 if alone else clusters.setdefault(r["cluster"], len(clusters))
        pieces.append((r["size"], source, cluster))
    placed = dict(zip(order, best_fit(pieces, capacity)))
    bins = pa.array([placed[i] for i in range(len(rows))], type=pa.int64())
    return pa.table(
        {
            "shard": group.column("shard"),
            "bin": bins,
            "id": group.column("id"),
            "part": group.column("part"),
            "size": group.column("size"),
            "source": group.column("source"),
            "cluster": group.column("cluster"),
        }
    )


def token_estimate(text: Column) -> Column:
    """Tokens of a text, estimated from its UTF-8 bytes."""
    return F.ceil(F.octet_length(text) / F.lit(BYTES_PER_TOKEN)).cast("long")


def _with_clusters(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``rows`` (a text last, its hash ``raw`` before it) with ``cluster`` in place of both.

    The texts are read once for nodes and bands, and those that have a candidate
    once more. Rows without a text go round the join: they have no node.
    """
    found = materialize(sketched(rows))
    near = near_copies(docs, found.select("raw", "node", "bands"))
    plain = found.drop("raw", "bands")
    met = plain.where("node is not null").join(near, "node", "left")
    met = met.withColumn("cluster", F.coalesce("component", "node")).drop("component", "node")
    none = plain.where("node is null").withColumnRenamed("node", "cluster")
    return met.unionByName(none)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    size: Column | None = None,
    source: Column | None = None,
    cluster: Column | None = None,
    capacity: int = CAPACITY,
    shard_docs: int = SHARD_DOCS,
) -> DataFrame:
    """(shard, bin, id, part, size, source, cluster): every piece of every row and its bin.

    A row longer than ``capacity`` is cut into parts 0, 1, ... of full capacity
    and a rest; shorter ones are part 0 whole. Sizes default to an estimate from
    the bytes of ``text``, sources to ``source``, clusters to the components of
    near copies of ``text`` (0.8 of the five-word shingles, compared; case and white
    space play no part; blank texts are copies of each other). NULL sources and clusters conflict with nothing; NULL
    texts and ids are packed like others, a size under 1 takes one place.
    Repeated rows are separate pieces of one cluster. Every row comes out; an
    empty table gives an empty one.
    """
    size = token_estimate(F.col("text")) if size is None else size
    source = F.col("source") if source is None else source
    named = [
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(size, F.lit(0)).cast("long").alias("total"),
        source.cast("string").alias("source"),
    ]
    if cluster is None:
        text = F.col("text").cast("string")
        raw = F.xxhash64(text).alias("raw")
        key = F.xxhash64(f"`{id_col}`", size, raw).alias("key")
        whole = _with_clusters(docs.select(*named, key, raw, text.alias("text")), docs)
        whole = materialize(whole)
    else:
        key = F.xxhash64(f"`{id_col}`", size, cluster).alias("key")
        whole = docs.select(*named, key, cluster.alias("cluster"))
    shards = max(1, -(-whole.count() // shard_docs))
    last = F.greatest(F.floor((F.col("total") - 1) / capacity), F.lit(0)).cast("int")
    pieces = whole.select(
        "id", "total", "source", "cluster", "key", F.explode(F.sequence(F.lit(0), last)).alias("part")
    ).select(
        "id",
        "part",
        F.least(F.col("total") - F.col("part") * capacity, F.lit(capacity)).cast("long").alias("size"),
        "source",
        "cluster",
        "key",
        # parts of one long document spread over the shards as well
        F.pmod(F.xxhash64("key", "part"), F.lit(shards)).alias("shard"),
    )
    kinds = dict(pieces.dtypes)
    schema = (
        f"shard long, bin long, id {kinds['id']}, part int, size long, "
        f"source string, cluster {kinds['cluster']}"
    )

    def run(group: pa.Table) -> pa.Table:
        return _pack_shard(group, capacity)

    return pieces.groupBy("shard").applyInArrow(run, schema)


def bins_of(packed: DataFrame) -> DataFrame:
    """One row per bin: its documents, the number of pieces and the tokens used."""
    piece = F.struct("part", "id", "size")
    return (
        packed.groupBy("shard", "bin")
        .agg(
            F.sort_array(F.collect_list(piece)).alias("pieces"),
            F.count(F.lit(1)).alias("n_pieces"),
            F.sum("size").alias("used"),
        )
        .select("shard", "bin", F.col("pieces.id").alias("doc_ids"), "pieces", "n_pieces", "used")
    )

