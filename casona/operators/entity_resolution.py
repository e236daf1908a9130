"""Entity resolution: embedding text, nearest candidates, pair scores, decisions, clusters, reviews."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from casona import refdata
from casona.functions import geo, vectors
from casona.functions.text import as_col
from casona.operators import neighbours
from casona.operators.graph import connected_components
from casona.operators.ranking import newest, top_n_per_key

CONFIDENCE = "decimal(3,2)"


# ---------------------------------------------------------------- embeddings

def embedding_text(title="title", locality="locality", province="province", bedrooms="bedrooms",
                   bathrooms="bathrooms", interior_sqm="interior_sqm", price_usd="price_usd") -> Column:
    """One line per listing, same shape whatever is missing."""
    part = lambda c: F.coalesce(as_col(c).cast("string"), F.lit(""))
    return F.concat(
        part(title), F.lit(" | "), part(locality), F.lit(", "), part(province), F.lit(" | "),
        part(bedrooms), F.lit("br "), part(bathrooms), F.lit("ba "), part(interior_sqm), F.lit("m² | $"),
        part(price_usd),
    )


def text_hash(c) -> Column:
    return F.sha2(as_col(c), 256)


def skip_unchanged(df: DataFrame, embeddings: DataFrame, model: str) -> DataFrame:
    """Rows (id, text_hash, ...) whose embedding for this model is not stored yet."""
    stored = embeddings.filter(F.col("model") == model).select("id", "text_hash").distinct()
    return df.join(stored, ["id", "text_hash"], "left_anti")


# ---------------------------------------------------------------- nearest candidates

def _matrix(vectors_: pd.Series) -> np.ndarray:
    m = np.vstack(vectors_.to_numpy()).astype(np.float64)
    norms = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)


def _best_k(q_ids, q_mat, b_ids, b_mat, k, exclude_self, tile=1024) -> pd.DataFrame:
    """Best k base rows of every query row, scored tile by tile so memory stays small.

    Of a tile only scores at or above its row's k-th best there, and above that of the tiles
    before, are sorted.
    """
    names, codes = np.unique(np.concatenate([q_ids, b_ids]), return_inverse=True)
    q_codes, b_codes = codes[: len(q_ids)], codes[len(q_ids):]
    found = [pd.DataFrame({"query_id": np.empty(0, int), "base_id": np.empty(0, int), "similarity": np.empty(0)})]
    for first in range(0, len(q_ids), tile):
        queries, own = q_codes[first:first + tile], q_mat[first:first + tile]
        best = np.full(len(queries), -np.inf)
        row, base, score = np.empty(0, int), np.empty(0, int), np.empty(0)
        for start in range(0, len(b_ids), tile):
            ids = b_codes[start:start + tile]
            sims = own @ b_mat[start:start + tile].T
            sims[~np.isfinite(sims)] = -np.inf
            if exclude_self:
                sims[queries[:, None] == ids[None, :]] = -np.inf
            if sims.shape[1] > k:
                best = np.maximum(best, np.partition(sims, -k, axis=1)[:, -k])
            r, c = np.nonzero((sims >= best[:, None]) & np.isfinite(sims))
            row, base, score = np.r_[row, r], np.r_[base, ids[c]], np.r_[score, sims[r, c]]
            # ties at the cut must go to the smaller id, so rank on (similarity, id)
            order = np.lexsort((base, -score, row))
            row, base, score = row[order], base[order], score[order]
            starts = np.searchsorted(row, np.arange(len(queries)))
            kept = np.arange(len(row)) - starts[row] < k
            row, base, score = row[kept], base[kept], score[kept]
        found.append(pd.DataFrame({"query_id": queries[row], "base_id": base, "similarity": score}))
    out = pd.concat(found)
    return out.assign(query_id=names[out.query_id.to_numpy(int)], base_id=names[out.base_id.to_numpy(int)])


#: Chunks that a block is cut into, and the rows that a chunk may hold before there are more chunks.
MOST_CHUNKS, MOST_CHUNK_ROWS = 24, 16_384


def top_k_similar(
    queries: DataFrame, base: DataFrame, k: int = refdata.TOP_K, id_col: str = "id", vec_col: str = "embedding",
    blocking: list[str] | None = None, exclude_self: bool = False, rows_per_chunk: int = 4096,
) -> DataFrame:
    """Exact k nearest base rows by cosine: (query_id, base_id, similarity, rank).

    Both sides are cut into hashed chunks of about ``rows_per_chunk`` per block, or larger ones of
    up to MOST_CHUNK_ROWS where there would be over MOST_CHUNKS of them (each row is copied once a
    chunk of the other side), and every (query chunk, base chunk) of a block is one task-sized group
    that multiplies two small matrices and returns only its k best per query. The k-best lists
    are then merged by a pushed-down row_number. A hot block becomes more groups, never a
    bigger one, and scored pairs never leave their group. ``blocking`` names columns that must
    be equal on both sides; ids keep their own type, the same on both sides. Leave it out only for small inputs, since work then grows with
    |queries| x |base|. For approximate search without blocks use ``lsh_candidates``.
    """
    blocking = blocking or []
    block = F.struct(*blocking).alias("_block") if blocking else F.lit(0).alias("_block")

    def chunked(df: DataFrame, prefix: str) -> tuple[DataFrame, DataFrame]:
        rows = df.select(block, F.col(id_col).alias(f"{prefix}_id"), F.col(vec_col).alias(f"{prefix}_vec"))
        rows = rows.filter(F.col(f"{prefix}_vec").isNotNull())
        count = F.count("*")
        chunks = F.greatest(F.least(F.ceil(count / rows_per_chunk), F.lit(MOST_CHUNKS)), F.ceil(count / MOST_CHUNK_ROWS))
        return rows, rows.groupBy("_block").agg(chunks.cast("int").alias(f"_{prefix}_chunks"))

    q, q_sizes = chunked(queries, "q")
    b, b_sizes = chunked(base, "b")
    sizes = q_sizes.join(b_sizes, "_block")
    if not blocking:
        sizes = F.broadcast(sizes)  # one row: a shuffle by block would put all rows into one task

    def spread(rows: DataFrame, prefix: str, own: str, other: str, key: list[str]) -> DataFrame:
        mine = F.pmod(F.xxhash64(f"{prefix}_id"), F.col(own)).cast("int").alias(key[0])
        copies = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(key[1])
        return rows.join(sizes, "_block").select("_block", mine, copies, f"{prefix}_id", f"{prefix}_vec")

    left = spread(q, "q", "_q_chunks", "_b_chunks", ["_qc", "_bc"])
    right = spread(b, "b", "_b_chunks", "_q_chunks", ["_bc", "_qc"]).select("_block", "_qc", "_bc", "b_id", "b_vec")
    left = left.select("_block", "_qc", "_bc", "q_id", "q_vec")

    def score(l: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if l.empty or r.empty:
            return pd.DataFrame({"query_id": [], "base_id": [], "similarity": []})
        return _best_k(l.q_id.to_numpy(), _matrix(l.q_vec), r.b_id.to_numpy(), _matrix(r.b_vec), k, exclude_self)

    keys = ["_block", "_qc", "_bc"]
    kinds = [df.schema[id_col].dataType.simpleString() for df in (queries, base)]
    result = f"query_id {kinds[0]}, base_id {kinds[1]}, similarity double"
    scored = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(score, result)
    return top_n_per_key(scored, ["query_id"], [F.desc("similarity"), F.asc("base_id")], k)


def lsh_candidates(
    queries: DataFrame, base: DataFrame, min_similarity: float, id_col: str = "id", vec_col: str = "embedding",
    missed: float = 1e-6, seed: int = 7,
) -> DataFrame:
    """Pairs at or above a cosine, without blocks: (query_id, base_id, similarity); ids keep their type.

    Vectors are compared inside tiles, out of which only pairs at or above the threshold come:
    tiles of two blocks, which hold all pairs, or for long tables buckets of bands of sign bits,
    as many as it takes to miss a pair at the threshold with a probability of ``missed``
    (``neighbours.cross_links``). Vectors that are null or zero have no pairs.
    """
    return neighbours.cross_links(queries, base, min_similarity, id_col, vec_col, missed, seed=seed)


# ---------------------------------------------------------------- pairs

def pair_features(pairs: DataFrame) -> DataFrame:
    """Comparison columns of pairs whose sides carry the prefixes ``a_`` and ``b_``."""
    a, b = (lambda n: F.col(f"a_{n}")), (lambda n: F.col(f"b_{n}"))
    ratio = lambda n: F.when(
        F.greatest(a(n), b(n)) > 0,
        F.abs(a(n).cast("double") - b(n).cast("double")) / F.greatest(a(n), b(n)).cast("double"),
    )
    return pairs.withColumns({
        "same_locality": a("locality") == b("locality"),
        "same_canton": a("canton") == b("canton"),
        "same_bedrooms": a("bedrooms") == b("bedrooms"),
        "same_bathrooms": a("bathrooms") == b("bathrooms"),
        "same_type": a("property_type") == b("property_type"),
        "same_mls": a("mls_id") == b("mls_id"),
        "same_agent": a("listing_agent_name") == b("listing_agent_name"),
        "same_address": a("address_line") == b("address_line"),
        "price_gap": ratio("price_usd"),
        "lot_gap": ratio("lot_sqm"),
        "interior_gap": ratio("interior_sqm"),
        "distance_km": geo.haversine_km(a("lat"), a("lng"), b("lat"), b("lng")),
    })


def score_pairs(features: DataFrame) -> DataFrame:
    """Confidence in [0, 1] from the pair features, by the judge's stated signals.

    Strong: same MLS id; same coordinates (50 m); same address with the same agent; same
    canton or street with lot or interior within 20 %; same beds, baths, price and locality.
    Against: other bedroom count, lot off by over 20 %, price off by over 30 %, other type.
    """
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    within = lambda c, x: F.coalesce(F.col(c) <= x, F.lit(False))
    beyond = lambda c, x: F.coalesce(F.col(c) > x, F.lit(False))
    differs = lambda c: F.coalesce(~F.col(c), F.lit(False))
    points = lambda cond, p: F.when(cond, F.lit(p)).otherwise(F.lit("0.00")).cast("decimal(6,2)")
    similar_size = within("lot_gap", 0.2) | within("interior_gap", 0.2)
    total = (
        points(yes("same_mls"), "0.90")
        + points(within("distance_km", 0.05), "0.40")
        + points(yes("same_address") & yes("same_agent"), "0.40")
        + points((yes("same_canton") | yes("same_address")) & similar_size, "0.25")
        + points(
            yes("same_bedrooms") & yes("same_bathrooms") & within("price_gap", 0.0) & yes("same_locality"), "0.40")
        + points(yes("same_locality"), "0.10")
        - points(differs("same_bedrooms"), "0.25")
        - points(beyond("lot_gap", 0.2), "0.20")
        - points(beyond("price_gap", 0.3), "0.25")
        - points(differs("same_type"), "0.30")
    )
    clamped = F.greatest(F.lit("0.00").cast("decimal(6,2)"), F.least(F.lit("1.00").cast("decimal(6,2)"), total))
    return features.withColumn("confidence", clamped.cast(CONFIDENCE))


def best_candidate(scored: DataFrame, merge_threshold: float = refdata.MERGE_THRESHOLD) -> DataFrame:
    """One row per query of (query_id, base_id, rank, confidence): the first candidate in similarity
    order that reaches the merge threshold, else the most confident one, earlier rank first."""
    strong = F.col("confidence") >= F.lit(str(merge_threshold)).cast("decimal(4,3)")
    preference = F.struct(
        F.when(strong, 0).otherwise(1), F.when(strong, F.lit(0)).otherwise(-F.col("confidence").cast("double")),
        F.col("rank"),
    )
    picked = F.min_by(F.struct("base_id", "rank", "confidence"), preference)
    return scored.groupBy("query_id").agg(picked.alias("_p")).select("query_id", "_p.*")


def decide(
    new: DataFrame, best: DataFrame, id_col: str = "id", merge_threshold: float = refdata.MERGE_THRESHOLD,
    review_threshold: float = refdata.REVIEW_THRESHOLD,
) -> DataFrame:
    """merge, review or create for every new listing; without a candidate ``no_match`` at 0.

    ``candidate_id`` keeps the listing compared against, also for review and create.
    """
    hits = best.select(F.col("query_id").alias("_q"), F.col("base_id").alias("candidate_id"), F.col("confidence").alias("_c"))
    joined = new.join(hits, F.col(id_col) == F.col("_q"), "left")
    at_least = lambda t: F.col("_c") >= F.lit(str(t)).cast("decimal(4,3)")
    return joined.withColumns({
        "action": F.when(at_least(merge_threshold), "merge").when(at_least(review_threshold), "review").otherwise("create"),
        "confidence": F.coalesce(F.col("_c"), F.lit(0)).cast(CONFIDENCE),
        "method": F.when(F.col("_q").isNull(), "no_match").otherwise("embedding"),
        "canonical_id": F.when(at_least(review_threshold), F.col("candidate_id")),
    }).drop("_q", "_c")


METHOD_RANK = {"exact_id": 1, "address_price": 2, "embedding": 3}


def exact_key_matches(new: DataFrame, canon: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, canonical_id, method): same MLS id, else same address and price; one match per listing.

    Canonicals are reduced to one per key before the join, so a key shared by many
    listings on both sides stays linear.
    """
    def match(keys: list[str], method: str) -> DataFrame:
        have = None
        for k in keys:
            have = F.col(k).isNotNull() if have is None else have & F.col(k).isNotNull()
        targets = canon.filter(have).groupBy(*keys).agg(F.min(id_col).alias("canonical_id"))
        return new.filter(have).join(targets, keys).select(
            id_col, "canonical_id", F.lit(method).alias("method"), F.lit(METHOD_RANK[method]).alias("_rank")
        )

    both = match(["mls_id"], "exact_id").unionByName(match(["address_line", "price_usd"], "address_price"))
    picked = F.min_by(F.struct("canonical_id", "method"), F.struct("_rank", "canonical_id"))
    return both.groupBy(id_col).agg(picked.alias("_m")).select(id_col, "_m.*")


def resolve(
    new: DataFrame, candidates_fn: Callable[[DataFrame], DataFrame], score_fn: Callable[[DataFrame], DataFrame],
    id_col: str = "id", merge_threshold: float = refdata.MERGE_THRESHOLD,
    review_threshold: float = refdata.REVIEW_THRESHOLD,
) -> DataFrame:
    """Decision per new listing with the candidate finder and the judge given as functions.

    ``candidates_fn(new)`` returns (query_id, base_id, rank, ...); ``score_fn(pairs)`` adds confidence.
    """
    scored = score_fn(candidates_fn(new))
    return decide(new, best_candidate(scored, merge_threshold), id_col, merge_threshold, review_threshold)


# ---------------------------------------------------------------- clusters

def same_key_edges(df: DataFrame, id_col: str, keys: list[str]) -> DataFrame:
    """Edges (a, b) linking rows of equal keys: each row to the smallest id of its group.

    A star per group, so a group of n rows gives n - 1 edges and not n squared pairs.
    """
    heads = df.groupBy(*keys).agg(F.min(id_col).alias("b"))
    return df.join(heads, keys).filter(F.col(id_col) != F.col("b")).select(F.col(id_col).alias("a"), "b")


def cluster_batch(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): (id, cluster_id) with the smallest id as cluster id.

    Rounds grow with the logarithm of the longest chain whatever the order of its ids.
    """
    return connected_components(edges).select("id", F.col("component").alias("cluster_id"))


# ---------------------------------------------------------------- review

def review_queue(
    links: DataFrame, canon: DataFrame, raw: DataFrame, low: float = 0.60, high: float = 0.85, n: int | None = None
) -> DataFrame:
    """Most confident unreviewed links in [low, high] with the compared listing and the raw record.

    ``n`` is the size of the report, by default all. Links carry link_id, raw_id, candidate_id,
    confidence, method, reviewed_at; the joins see only the report's rows on the left.
    """
    bound = lambda x: F.lit(str(x)).cast("decimal(4,3)")
    top = (
        links.filter(F.col("reviewed_at").isNull() & F.col("confidence").between(bound(low), bound(high)))
    )
    if n is not None:
        top = F.broadcast(top.orderBy(F.desc("confidence"), "link_id").limit(n))  # at most n rows
    c = canon.select(F.col("id").alias("candidate_id"), *(F.col(x).alias(f"canon_{x}") for x in canon.columns if x != "id"))
    r = raw.select(F.col("id").alias("raw_id"), *(F.col(x).alias(f"raw_{x}") for x in raw.columns if x != "id"))
    # big tables are filtered down to the report's rows first; both joins are inner on n rows
    kept_c = c.join(top.select("candidate_id").distinct(), "candidate_id", "left_semi")
    kept_r = r.join(top.select("raw_id").distinct(), "raw_id", "left_semi")
    return top.join(kept_c, "candidate_id", "left").join(kept_r, "raw_id", "left").orderBy(F.desc("confidence"), "link_id")


def apply_review(links: DataFrame, decisions: DataFrame, agents: DataFrame, at: Column) -> DataFrame:
    """Stamp decisions (link_id, decision, email, seq) onto links, the newest of a link; reviewer by e-mail, null when unknown."""
    who = agents.groupBy(F.col("email").alias("email")).agg(F.min("id").alias("_agent"))
    verdicts = (
        decisions.groupBy("link_id").agg(F.max_by(F.struct("decision", "email"), newest(decisions, "decision", "email")).alias("_d"))
        .select("link_id", "_d.*").join(who, "email", "left")
        .select("link_id", F.col("decision").alias("_decision"), "_agent")
    )
    accept = F.col("_decision") == "accept"
    touched = F.col("_decision").isNotNull()
    return links.join(verdicts, "link_id", "left").withColumns({
        "method": F.when(accept, "human").when(touched, "human_rejected").otherwise(F.col("method")),
        "confidence": F.when(accept, F.lit(1)).when(touched, F.lit(0)).otherwise(F.col("confidence")).cast(CONFIDENCE),
        "reviewed_by": F.when(touched, F.col("_agent")).otherwise(F.col("reviewed_by")),
        "reviewed_at": F.when(touched, at).otherwise(F.col("reviewed_at")),
    }).drop("_decision", "_agent")


def similar_listings(listings: DataFrame, listing_id, n: int = 6) -> DataFrame:
    """``n`` active listings of the same region, closest embedding first (id breaks ties).

    The one listing asked about is a single row, so it is broadcast against a plain scan.
    """
    me = listings.filter(F.col("id") == listing_id).limit(1).select(
        F.col("region_slug").alias("_region"), F.col("embedding").alias("_vec")
    )
    others = listings.filter((F.col("status") == "active") & (F.col("id") != listing_id))
    scored = others.join(F.broadcast(me), F.col("region_slug") == F.col("_region")).withColumn(
        "similarity", vectors.cosine_similarity("embedding", "_vec")
    )
    return scored.drop("_region", "_vec").orderBy(F.desc_nulls_last("similarity"), "id").limit(n)
