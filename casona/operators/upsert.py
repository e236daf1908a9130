"""Upserts and edits as pure functions (current, changes) -> next, on full outer or anti joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from casona import refdata, schemas
from casona.functions.text import non_empty, strip
from casona.operators.ranking import newest


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row of every key in a total order, by one combining aggregate (no per-key sort)."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*").select(*df.columns)


def _outer(current: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    c = current.select(*keys, F.struct(*current.columns).alias("_old"))
    n = changes.select(*keys, F.struct(*changes.columns).alias("_new"))
    return c.join(n, list(keys), "full_outer")


def upsert(current: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``changes`` replace those of equal keys or are added; needs one change per key."""
    joined = _outer(current, changes, keys)
    has_new = F.col("_new").isNotNull()
    cols = []
    for c in current.columns:
        if c in keys:
            cols.append(F.col(c))
        elif c in changes.columns:
            cols.append(F.when(has_new, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c))
        else:
            cols.append(F.col(f"_old.{c}").alias(c))
    return joined.select(*cols)


RAW_KEY = ["source", "source_listing_id"]


def upsert_raw(current: DataFrame, payloads: DataFrame, order: Sequence[str] = ("scraped_at",)) -> DataFrame:
    """Raw table after a run: content replaced or added by (source, id), its stages reset to pending.

    The last arrival of a key wins. ``was_new`` is true for inserts, false for updates, null for
    rows the run did not touch. Applying the same payloads twice gives the same table.
    """
    # rows are sorted by the key's columns: the one that tells most of them apart goes first
    batch = latest_per_key(payloads, RAW_KEY[::-1], order)
    joined = _outer(current, batch, RAW_KEY[::-1])
    touched, existed = F.col("_new").isNotNull(), F.col("_old").isNotNull()
    content = [c for c in batch.columns if c not in RAW_KEY]
    cols = [F.col(k) for k in RAW_KEY]
    for c in current.columns:
        if c in RAW_KEY or c == "was_new":
            continue
        old = F.col(f"_old.{c}")
        if c in content:
            cols.append(F.when(touched, F.col(f"_new.{c}")).otherwise(old).alias(c))
        elif c in refdata.STAGE_COLUMNS:
            cols.append(F.when(touched, F.lit("pending")).otherwise(old).alias(c))
        elif c == "error":
            cols.append(F.when(~touched, old).alias(c))
        else:
            cols.append(old.alias(c))
    return joined.select(*cols, F.when(touched, ~existed).alias("was_new"))


def _present(column: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.ArrayType):
        return F.when(F.size(column) > 0, column)
    return column


def fold_changes(changes: DataFrame, order: Sequence[str], key: str = "id", modes: dict[str, str] | None = None) -> DataFrame:
    """One change per canonical row: newest present value of replaced columns, oldest of filled ones."""
    modes = modes or schemas.MERGE_MODES
    aggs = []
    for f in changes.schema.fields:
        if f.name == key or f.name in order:
            continue
        value = _present(F.col(f.name), f.dataType)
        pick = F.min_by if modes.get(f.name) in ("fill", "keep") else F.max_by
        aggs.append(pick(F.col(f.name), F.when(value.isNotNull(), F.struct(*order))).alias(f.name))
    return changes.groupBy(key).agg(*aggs)


def merge_canonical(
    current: DataFrame, changes: DataFrame, at: Column, key: str = "id", modes: dict[str, str] | None = None
) -> DataFrame:
    """Matched rows take the change's columns by mode; last_seen_at and updated_at become ``at``.

    ``replace`` takes a present new value, ``fill`` only closes gaps, ``keep`` never moves. Nulls
    and empty arrays erase nothing. ``changes`` holds one row per key (see fold_changes). A column
    that both sides have and that no mode names is an error: its new values would be lost.
    """
    modes = modes or schemas.MERGE_MODES
    stamps = {key, "last_seen_at", "updated_at"}
    unnamed = [c for c in current.columns if c in changes.columns and c not in modes and c not in stamps]
    if unnamed:
        raise ValueError(f"no merge mode for {', '.join(unnamed)}")
    n = changes.select(F.col(key).alias("_key"), F.struct(*changes.columns).alias("_new"))
    joined = current.join(n, current[key] == F.col("_key"), "left")
    touched = F.col("_key").isNotNull()
    cols = []
    for f in current.schema.fields:
        old, mode = F.col(f.name), modes.get(f.name, "keep")
        if f.name in ("last_seen_at", "updated_at"):
            cols.append(F.when(touched, at).otherwise(old).alias(f.name))
        elif f.name == key or f.name not in changes.columns or mode == "keep":
            cols.append(old)
        else:
            new = _present(F.col(f"_new.{f.name}"), f.dataType)
            if mode == "replace":
                value = F.coalesce(new, old)
            else:
                value = F.coalesce(_present(old, f.dataType), new, old)
            cols.append(value.cast(f.dataType).alias(f.name))
    return joined.select(*cols)


def quality_gate(title_en="title_en", title_es="title_es", title="title", action="action") -> Column:
    """pending_review for thin or to-be-reviewed listings, else active.

    Thin: no title in any language, or none of price, bedrooms, interior and lot size.
    """
    blank = lambda c: F.coalesce(strip(c) == "", F.lit(True))
    untitled = blank(title_en) & blank(title_es) & blank(title)
    anchors = [F.col(c).isNull() for c in ("price_usd", "bedrooms", "interior_sqm", "lot_sqm")]
    bare = anchors[0] & anchors[1] & anchors[2] & anchors[3]
    return F.when(untitled | bare | (F.col(action) == "review"), "pending_review").otherwise("active")


def insert_canonical(current: DataFrame, new: DataFrame, at: Column, key_columns: Sequence[str]) -> DataFrame:
    """Adds created and reviewed listings: id from the cluster key, status by the gate, fixed defaults."""
    rows = new.filter("action <> 'merge'").withColumns({
        "id": F.sha2(F.concat_ws("|", *(F.col(c).cast("string") for c in key_columns)), 256),
        "status": quality_gate(),
        "listing_type": F.lit("sale"),
        "country": F.lit("CR"),
        "property_type": F.coalesce("property_type", F.lit("other")),
        "created_at": at, "updated_at": at, "last_seen_at": at,
    })
    fresh = rows.join(current.select("id"), "id", "left_anti")
    wanted = [c for c in fresh.columns if c in current.columns]
    return current.unionByName(fresh.select(*wanted), allowMissingColumns=True)


def _one_change(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest change of every key, by ``seq`` if there is one; ties go to the largest values."""
    rest = sorted(c for c in changes.columns if c not in keys and c != "seq")
    return latest_per_key(changes, keys, [*(["seq"] if "seq" in changes.columns else []), *rest])


def upsert_links(current: DataFrame, changes: DataFrame) -> DataFrame:
    """(canonical_id, raw_id) edges; confidence and method replaced, review stamps kept. The newest change of an edge counts."""
    keys = ["canonical_id", "raw_id"]
    return upsert(current, _one_change(changes, keys), keys)


def upsert_embeddings(current: DataFrame, changes: DataFrame) -> DataFrame:
    """(canonical_id, model) vectors; vector and text hash replaced. The newest change of a key counts."""
    keys = ["canonical_id", "model"]
    return upsert(current, _one_change(changes, keys), keys)


def lineage(raw: DataFrame, links: DataFrame, canon: DataFrame, sync_log: DataFrame) -> DataFrame:
    """Trace of every raw record: canonical listing, method, and its published post if any."""
    posts = sync_log.filter("status = 'success'").groupBy("canonical_id").agg(
        F.max_by(F.struct("post_id", "logged_at"), "logged_at").alias("_p"))
    return (
        raw.select(F.col("id").alias("raw_id"), "source", "source_url")
        .join(links.select("raw_id", "canonical_id", "method", "confidence"), "raw_id", "left")
        .join(canon.select(F.col("id").alias("canonical_id"), "slug", "status"), "canonical_id", "left")
        .join(posts, "canonical_id", "left")
        .select("raw_id", "source", "source_url", "canonical_id", "method", "confidence", "slug", "status",
                F.col("_p.post_id").alias("post_id"), F.col("_p.logged_at").alias("published_at"))
    )


def source_urls(raw: DataFrame, links: DataFrame) -> DataFrame:
    """Every source URL of every canonical listing, one row each (no per-listing array to outgrow a task)."""
    r = raw.select(F.col("id").alias("raw_id"), "source_url")
    return links.select("canonical_id", "raw_id").join(r, "raw_id").select("canonical_id", "source_url").distinct()


# ---------------------------------------------------------------- edits by people

def apply_patches(
    canon: DataFrame, patches: DataFrame, at: Column, editable: Sequence[str] | None = None, key: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """(next table, rejected patches). A patch is (key, fields map<string,string>, seq).

    Of several patches of a row every field takes its newest value by ``seq``. Only editable columns are taken, '' clears a column, and a patch without any editable column
    is rejected. Text is cast to the column's type; arrays are given as JSON.
    """
    allowed = [c for c in (editable or schemas.EDITABLE) if c in canon.columns]
    names = F.array(*map(F.lit, allowed))
    usable = F.map_filter("fields", lambda k, v: F.array_contains(names, k))
    checked = patches.withColumn("_usable", usable)
    good = checked.filter(F.size("_usable") > 0)
    rejected = checked.filter(F.size("_usable") == 0).select(key, "fields").withColumn(
        "error", F.lit("no editable fields in body"))
    each = good.select(key, *(c for c in ("seq",) if c in good.columns), F.explode("_usable").alias("_field", "_value"))
    folded = each.groupBy(key, "_field").agg(F.max_by(F.struct("_value"), newest(each, "_value")).alias("_v"))
    p = folded.groupBy(F.col(key).alias("_key")).agg(
        F.map_from_entries(F.collect_list(F.struct("_field", "_v._value"))).alias("_patch"))
    joined = canon.join(p, canon[key] == F.col("_key"), "left")
    types = {f.name: f.dataType for f in canon.schema.fields}

    def typed(name):
        raw = non_empty(F.try_element_at("_patch", F.lit(name)))
        kind = types[name]
        return F.from_json(raw, kind) if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)) else raw.try_cast(kind)

    cols = []
    for name in canon.columns:
        if name in allowed:
            cols.append(F.when(F.map_contains_key("_patch", F.lit(name)), typed(name)).otherwise(F.col(name)).alias(name))
        elif name == "updated_at":
            cols.append(F.when(F.col("_key").isNotNull(), at).otherwise(F.col(name)).alias(name))
        else:
            cols.append(F.col(name))
    return joined.select(*cols), rejected


def parse_form_values(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Form text -> typed columns; kinds are number, boolean, array and text. '' is null."""
    out = {}
    for name, kind in spec.items():
        c = non_empty(name)
        if kind == "number":
            out[name] = strip(c).try_cast("double")
        elif kind == "boolean":
            out[name] = F.when(c == "true", True).when(c == "false", False)
        elif kind == "array":
            out[name] = F.filter(F.transform(F.split(c, ","), strip), lambda x: x != "")
        else:
            out[name] = c
    return df.withColumns(out)


def create_manual(canon: DataFrame, entries: DataFrame, at: Column, key: str = "entry_id") -> DataFrame:
    """Hand-entered listings with their defaults, added to the table."""
    have = set(entries.columns)
    given = lambda c, default: F.coalesce(F.col(c), default) if c in have else default
    stamp = F.substring(F.sha2(F.col(key).cast("string"), 256), 1, 8)
    rows = entries.withColumns({
        "id": F.sha2(F.concat(F.lit("manual|"), F.col(key).cast("string")), 256),
        "slug": given("slug", F.concat(F.lit("manual-"), stamp)),
        "status": given("status", F.lit("draft")),
        "listing_type": F.lit("sale"),
        "property_type": given("property_type", F.lit("other")),
        "price_currency": given("price_currency", F.lit("USD")),
        "realtor_review_status": F.lit("reviewed"),
        "created_at": at, "updated_at": at,
    })
    return canon.unionByName(
        rows.select(*(c for c in rows.columns if c in canon.columns)), allowMissingColumns=True)


def apply_human_fields(canon: DataFrame, edits: DataFrame, at: Column) -> DataFrame:
    """tags_human and agent_id replaced where an edit (slug, tags_human, agent_id, seq) gives them, the newest first."""
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), newest(edits, c)))
    e = edits.groupBy(F.col("slug").alias("_slug")).agg(last("tags_human").alias("_tags"), last("agent_id").alias("_agent"))
    return canon.join(e, canon["slug"] == F.col("_slug"), "left").withColumns({
        "tags_human": F.coalesce("_tags", "tags_human"),
        "agent_id": F.coalesce("_agent", "agent_id"),
        "updated_at": F.when(F.col("_slug").isNotNull(), at).otherwise(F.col("updated_at")),
    }).drop("_slug", "_tags", "_agent")


def delete_cascade(ids: DataFrame, listings: DataFrame, children: dict[str, tuple[DataFrame, str]]) -> dict[str, DataFrame]:
    """Listings and child tables (name -> (table, foreign key)) without the given listing ids."""
    gone = ids.select(F.col("id").alias("_gone")).distinct()
    out = {"listings": listings.join(gone, listings["id"] == F.col("_gone"), "left_anti")}
    for name, (child, fk) in children.items():
        out[name] = child.join(gone, child[fk] == F.col("_gone"), "left_anti")
    return out


# ---------------------------------------------------------------- schema and constraints

def ensure_columns(df: DataFrame, columns: dict[str, str], defaults: dict[str, Column] | None = None) -> DataFrame:
    """Adds the missing columns of a schema; arrays default to empty, others to null."""
    defaults = defaults or {}
    added = {}
    for name, kind in columns.items():
        if name in df.columns:
            continue
        value = defaults.get(name, F.array() if kind.startswith("array") else F.lit(None))
        added[name] = value.cast(kind)
    return df.withColumns(added) if added else df


def touch_updated_at(current: DataFrame, nxt: DataFrame, at: Column, key: str = "id") -> DataFrame:
    """``nxt`` with updated_at moved to ``at`` on rows that differ from ``current``."""
    content = [c for c in nxt.columns if c not in (key, "updated_at") and c in current.columns]
    digest = lambda: F.sha2(F.concat_ws("\n", *(F.to_json(F.struct(c), {"ignoreNullFields": "false"}) for c in content)), 256)
    before = current.select(F.col(key).alias("_key"), digest().alias("_before"))
    changed = ~digest().eqNullSafe(F.col("_before"))
    return nxt.join(before, nxt[key] == F.col("_key"), "left").withColumn(
        "updated_at", F.when(changed, at).otherwise(F.col("updated_at"))).drop("_key", "_before")


def referential_check(child: DataFrame, fk: str, parent: DataFrame, pk: str = "id") -> DataFrame:
    """Foreign keys without a parent, with their row counts; nulls are allowed."""
    orphans = child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("missing_key")).agg(F.count("*").alias("rows"))
    return orphans.join(parent.select(F.col(pk).alias("missing_key")).distinct(), "missing_key", "left_anti")


def unique_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")
