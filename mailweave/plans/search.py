"""Search over a table of queries: semantic, keyword and hybrid."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailweave.operators.dense import dense_rank_all
from mailweave.operators.encode import Encoder, embed_queries
from mailweave.operators.fused_top import fused_top
from mailweave.operators.fusion import combine, rrf
from mailweave.operators.joins import attach, broadcast_limit, salted_join
from mailweave.operators.keyword import keyword_search
from mailweave.operators.query_parse import expand_queries, parse_queries
from mailweave.operators.ranking import GROUP_LIMIT, number_docs
from mailweave.plans.mailboxes import build_vectors
from mailweave.session import stored
from mailweave.sources.postings import Index, load_index, stored_index, write_index
from mailweave.sources.store import check_folder, load_vectors, mail_block, write_vectors

MODES = ("hybrid", "semantic", "keyword")
ROW_BYTES = 64


@dataclass(frozen=True)
class Store:
    """What a search reads: mails, vectors, keyword index, alias rows ``(Name, Alias)``."""

    corpus: DataFrame
    vectors: DataFrame | None = None
    index: Index | None = None
    aliases: DataFrame | None = None

    def folder(self, name: str) -> Store:
        """The part of one folder."""
        pick = lambda df: None if df is None else df.filter(F.col("folder") == name)
        index = self.index
        if index is not None:
            index = Index(pick(index.postings), pick(index.terms), pick(index.fields), pick(index.exact))
        return replace(self, corpus=pick(self.corpus), vectors=pick(self.vectors), index=index)


def open_store(
    corpus: DataFrame,
    aliases: DataFrame | None = None,
    encoder: Callable[[], Encoder] | None = None,
    dim: int = 64,
) -> Store:
    """Build vectors and keyword index of a corpus in the shared folder.

    Encoding is heavy per mail, so the mails are spread first.
    """
    vectors = build_vectors(corpus.repartition("Id"), encoder, dim=dim)
    return Store(corpus, stored(vectors, "vectors"), stored_index(corpus), aliases)


def save_store(
    corpus: DataFrame,
    path: str,
    aliases: DataFrame | None = None,
    encoder: Callable[[], Encoder] | None = None,
    dim: int = 64,
) -> None:
    """Build vectors and keyword index of a corpus below ``path``, for :func:`load_store`. The
    mails themselves stay where they are."""
    write_vectors(build_vectors(corpus.repartition("Id"), encoder, dim=dim), f"{path}/vectors")
    write_index(corpus, f"{path}/index")
    if aliases is not None:
        aliases.select("Name", "Alias").write.mode("overwrite").parquet(f"{path}/aliases")


def load_store(corpus: DataFrame, path: str, with_aliases: bool = True) -> Store:
    """Open what :func:`save_store` wrote, without encoding or indexing a mail again; ``corpus`` are
    the mails it was built of, as loaded from their mailbox. A missing part is an error."""
    spark = corpus.sparkSession
    aliases = spark.read.parquet(f"{path}/aliases") if with_aliases else None
    return Store(corpus, load_vectors(spark, f"{path}/vectors"), load_index(spark, f"{path}/index"), aliases)


def semantic_search(
    queries: DataFrame,
    vectors: DataFrame,
    encoder: Callable[[], Encoder] | None = None,
    variants: DataFrame | None = None,
    generator: Callable[[str], list[str]] | None = None,
    depth: int | None = None,
    dim: int = 64,
) -> DataFrame:
    """``(folder, qid, Id, score)``: fused vector rankings of all variants of a query.

    Every mail is ranked unless ``depth`` cuts the list of a variant, which changes scores.
    """
    expanded = expand_queries(queries, variants, generator)
    embedded = embed_queries(expanded, encoder, dim=dim)
    return rrf(dense_rank_all(embedded, vectors, depth))


def search_scores(
    queries: DataFrame,
    store: Store,
    folder: str | None = None,
    mode: str = "hybrid",
    n: int | None = 10,
    encoder: Callable[[], Encoder] | None = None,
    variants: DataFrame | None = None,
    generator: Callable[[str], list[str]] | None = None,
    boosts: bool = True,
    match: str = "exact",
    as_of: str | None = None,
    hits_only: bool = False,
    max_hits: int | None = None,
    dim: int = 64,
    keyword_mode: str = "boost",
) -> DataFrame:
    """``(folder, qid, Id, score, rank)`` for every query; both folders unless one is named.

    ``max_hits`` keeps that many keyword hits per folder and query, all by default. With
    ``keyword_mode="filter"`` sender and date restrict the keyword hits instead of raising them.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    check_folder(folder)
    part = store if folder is None else store.folder(folder)
    embedded = keyword = None
    if mode in ("hybrid", "semantic"):
        embedded = embed_queries(expand_queries(queries, variants, generator), encoder, dim=dim)
    if mode in ("hybrid", "keyword"):
        parsed = parse_queries(queries, as_of)
        keyword = keyword_search(
            parsed, part.index, part.aliases, boosts, keyword_mode, part.corpus, max_hits, match
        )
    if embedded is not None and n is not None and 0 < n <= GROUP_LIMIT:
        return fused_top(embedded, part.vectors, keyword, queries, part.corpus, n, hits_only)
    semantic = None if embedded is None else rrf(dense_rank_all(embedded, part.vectors, per_query=True))
    return combine(semantic, keyword, queries, part.corpus, n, hits_only)


def fetch(ranked: DataFrame, corpus: DataFrame, rows: int | None = None) -> DataFrame:
    """Ranked rows with their mails. ``rows`` is a proven bound on the ranked rows.

    A small bounded list is stored and broadcast, so the mails are not shuffled, and of a
    corpus in blocks only the blocks with results are read. Otherwise one mail may be a
    result of very many queries, and its rows are spread.
    """
    if rows is None or rows * ROW_BYTES > broadcast_limit(ranked):
        spread = ["qid"] if "qid" in ranked.columns else ["rank"]
        return salted_join(ranked, corpus, ["folder", "Id"], spread)
    ranked = stored(ranked, "top")
    if "block" in corpus.columns:
        corpus = _blocks_of(ranked, corpus)
    return corpus.join(F.broadcast(ranked), ["folder", "Id"])


def _blocks_of(ranked: DataFrame, corpus: DataFrame) -> DataFrame:
    """The blocks that hold ranked mails; their names are at most as many as directories."""
    sample = corpus.select("block").first()
    if sample is None:
        return corpus
    blocks = int(sample["block"].split("-")[0])
    named = ranked.select(mail_block(F.col("Id"), blocks).alias("block")).distinct().collect()
    return corpus.filter(F.col("block").isin([r["block"] for r in named])).drop("block")


def search(queries: DataFrame, store: Store, n: int = 10, numbered: bool = False, **options) -> DataFrame:
    """Top ``n`` mails of every query: the mail's columns with ``qid, score, rank``.

    With ``numbered`` each mail has its position in its folder by id, from 1, as ``doc_no``. It is
    counted for the mails found only: how many mails of the folder have a smaller id.
    """
    ranked = search_scores(queries, store, n=n, **options)
    rows = 2 * n * queries.count()
    if numbered:
        ranked = stored(ranked, "ranked")
        ranked = attach(ranked, positions(ranked, store.corpus, rows), ["folder", "Id"], ["qid"], size=rows * ROW_BYTES)
    return fetch(ranked, store.corpus, rows).orderBy("folder", "qid", "rank")


def positions(found: DataFrame, corpus: DataFrame, rows: int) -> DataFrame:
    """``(folder, Id, doc_no)`` of the mails ``found``, at most ``rows``, without numbering all others.

    The ids found cut each folder into stretches. Every mail falls into one (a search among sorted
    ids), the stretches are counted, and the counts added up.
    """
    wanted = found.select("folder", "Id").distinct()
    cuts = wanted.groupBy("folder").agg(F.array_sort(F.collect_set("Id")).alias("ids"))
    if rows * ROW_BYTES > broadcast_limit(found):
        numbered = number_docs(corpus.select("folder", "Id").distinct())
        return numbered.join(wanted, ["folder", "Id"], "left_semi")
    table = cuts.toArrow().to_pydict()
    shared = corpus.sparkSession.sparkContext.broadcast(
        {folder: np.array(ids, dtype=np.int64) for folder, ids in zip(table["folder"], table["ids"])}
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[str, np.ndarray] = {}
        for batch in batches:
            folders, ids = batch.column("folder").to_pandas().to_numpy(), batch.column("Id").to_numpy()
            for folder in np.unique(folders):
                if folder in shared.value:
                    known = shared.value[folder]
                    places = np.searchsorted(known, ids[folders == folder])
                    met[folder] = met.get(folder, 0) + np.bincount(places, minlength=len(known) + 1)
        for folder, counts in met.items():
            columns = [pa.array([folder] * (len(counts) - 1), pa.string()), pa.array(shared.value[folder]), pa.array(counts[:-1].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["folder", "Id", "n"])

    ids = corpus.select("folder", F.col("Id").cast("bigint")).distinct()
    stretches = ids.mapInArrow(count, "folder string, Id bigint, n bigint").groupBy("folder", "Id").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("folder").orderBy("Id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return stretches.select("folder", "Id", F.sum("n").over(before).alias("doc_no"))
