"""Shaping nested rows: projection, list cuts, token budgets, pages and views.

All functions build column expressions from the schema, so that any depth runs as one
native projection without moving rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeaudit import session
from lakeaudit.functions import formats, jsonsize
from lakeaudit.operators import paging, sliding

# List lengths tried under a budget, keys a fallback keeps, blocks a
# projection never drops, and the list lengths of the shorter views.
LADDER = (50, 25, 10, 5, 3, 1)
FALLBACK_KEYS = ("database", "schema", "table_info")
KEPT_BLOCKS = ("pagination", "_pagination", "_truncation")
HEALTH_ROWS = 10
MODEL_RELATIONSHIPS, MODEL_RECOMMENDATIONS, MODEL_ROWS = 10, 5, 12


# --- field projection ---------------------------------------------------------

def _path_tree(fields: str) -> dict:
    """Dotted paths as nested dicts; ``None`` stands for a whole value."""
    tree: dict = {}
    for path in fields.split(","):
        steps = [s for s in path.strip().split(".") if s]
        node = tree
        for i, step in enumerate(steps):
            if node.get(step, {}) is None:
                break
            if i == len(steps) - 1:
                node[step] = None
            else:
                node = node.setdefault(step, {})
    return tree


def _exists(dtype: T.DataType, tree: dict | None) -> bool:
    if tree is None:
        return True
    if isinstance(dtype, T.ArrayType):
        return _exists(dtype.elementType, tree)
    if isinstance(dtype, T.StructType):
        return any(k in dtype.names and _exists(dtype[k].dataType, t) for k, t in tree.items())
    return False


def _any_of(item: Column, fields: list[str]) -> Column:
    return F.coalesce(*[F.when(item[k].isNotNull(), True) for k in fields], F.lit(False))


def _projected(column: Column, dtype: T.DataType, tree: dict | None) -> Column:
    if tree is None:
        return column
    if isinstance(dtype, T.ArrayType):
        element = dtype.elementType
        if isinstance(element, T.StructType) and all(t is None for k, t in tree.items() if k in element.names):
            # Plain fields of list items: written so that a scan reads only these fields.
            fields = [k for k in tree if k in element.names]
            items = F.filter(F.arrays_zip(*[column.getField(k) for k in fields]), lambda x: _any_of(x, fields))
        else:
            items = F.filter(F.transform(column, lambda x: _projected(x, element, tree)), lambda x: x.isNotNull())
        return F.when(F.size(items) > 0, items)
    kept = [(k, t) for k, t in tree.items() if k in dtype.names and _exists(dtype[k].dataType, t)]
    parts = [_projected(column[k], dtype[k].dataType, t).alias(k) for k, t in kept]
    return F.when(F.coalesce(*[F.when(p.isNotNull(), True) for p in parts]), F.struct(*parts))


def field_projection(df: DataFrame, fields: str | None) -> DataFrame:
    """Only the named paths; list items and structs left without any value go.

    A path the schema lacks is ignored, and the rows stay as they are when none is left.
    """
    tree = {k: t for k, t in _path_tree(fields or "").items() if k in df.columns and _exists(df.schema[k].dataType, t)}
    if not tree:
        return df
    columns = [_projected(F.col(k), df.schema[k].dataType, t).alias(k) for k, t in tree.items()]
    return df.select(*columns, *[k for k in KEPT_BLOCKS if k in df.columns and k not in tree])


# --- list cuts and token budgets ----------------------------------------------

def _has_list(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_has_list(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.ArrayType)


def _cut(column: Column, dtype: T.DataType, most: Column) -> Column:
    if not _has_list(dtype):
        return column
    if isinstance(dtype, T.ArrayType):
        head = F.slice(column, F.lit(1), most)
        return F.transform(head, lambda x: _cut(x, dtype.elementType, most)) if _has_list(dtype.elementType) else head
    fields = [_cut(column[f.name], f.dataType, most).alias(f.name) for f in dtype.fields]
    return F.when(column.isNotNull(), F.struct(*fields))


def shrink_lists(df: DataFrame, most: int | Column) -> DataFrame:
    """Every list at any depth cut to its first items."""
    n = F.lit(most) if isinstance(most, int) else most
    return df.select(*[_cut(F.col(f.name), f.dataType, n).alias(f.name) for f in df.schema.fields])


def _flat_list(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.ArrayType) and not _has_list(dtype.elementType)


# Items whose sizes are added up item by item; beyond, whole blocks of them are added.
BLOCK_ITEMS = 32


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _prefix_sums(values: Column) -> Column:
    """0 and the sums of the first 1, 2, … values; each sum copies the ones before it."""
    return F.aggregate(values, F.array(F.lit(0).cast("long")), lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x)))


def _running_sizes(column: Column, element: T.DataType) -> Column:
    """0 and the characters of the first 1, 2, … items.

    Sums of blocks are summed first, and each block then starts from the sum before it. So the work of a
    list of n items is n x 32 and the square of n / 32, not the square of n.
    """
    each = F.transform(column, lambda x: jsonsize.json_chars(x, element).cast("long"))
    blocks = F.sequence(F.lit(0), F.greatest(F.floor((F.size(column) - 1) / F.lit(BLOCK_ITEMS)), F.lit(0)).cast("int"))

    def summed(sizes: Column) -> Column:
        parts = F.transform(blocks, lambda b: F.slice(sizes, b * BLOCK_ITEMS + 1, F.lit(BLOCK_ITEMS)))
        return _let(parts, lambda own: _let(
            _prefix_sums(F.transform(own, lambda p: F.aggregate(p, F.lit(0).cast("long"), lambda x, y: x + y))),
            lambda before: F.concat(
                F.array(F.lit(0).cast("long")),
                F.flatten(F.zip_with(own, before, lambda p, start: F.when(p.isNotNull(), F.transform(F.slice(_prefix_sums(p), F.lit(2), F.size(p)), lambda x: x + start)).otherwise(F.array().cast("array<long>")))),
            ),
        ))

    return F.when(F.size(column) <= BLOCK_ITEMS, _prefix_sums(each)).when(column.isNotNull(), _let(each, summed))


def _with_item_sizes(df: DataFrame) -> DataFrame:
    """Add ``_upto_<n>`` per plain list: the characters of its first k items, for every k."""
    sizes = {}
    for i, f in enumerate(df.schema.fields):
        if _flat_list(f.dataType):
            sizes[f"_upto_{i}"] = _running_sizes(F.col(f.name), f.dataType.elementType)
    return df.withColumns(sizes) if sizes else df


def _row_tokens(schema: T.StructType, most: int | None, summed: bool = False) -> Column:
    """Estimated tokens of a row with its lists cut to ``most`` items.

    With ``summed`` the sizes of plain lists are looked up in what ``_with_item_sizes`` added.
    """
    parts = []
    for i, f in enumerate(schema.fields):
        column = F.col(f.name)
        if summed and _flat_list(f.dataType):
            kept = F.size(column) if most is None else F.least(F.size(column), F.lit(most))
            inside = F.element_at(F.col(f"_upto_{i}"), kept + 1) + F.greatest(kept - 1, F.lit(0)) * 2 + 2
            chars = F.when(column.isNull(), F.lit(4).cast("long")).otherwise(inside)
        else:
            chars = jsonsize.json_chars(column if most is None else _cut(column, f.dataType, F.lit(most)), f.dataType)
        parts.append(chars + F.lit(len(f.name) + 4))
    return jsonsize.tokens(sum(parts[1:], parts[0]) + F.lit(2 * (len(parts) - 1) + 2))


def token_estimate(df: DataFrame, out: str = "tokens") -> DataFrame:
    return df.withColumn(out, _row_tokens(df.schema, None))


def token_budget(df: DataFrame, budget: int | None) -> DataFrame:
    """Each row cut to the longest lists of the ladder that fit the budget.

    ``_truncation`` tells what was done; it is NULL for an unchanged row and does not
    count itself. A row that fits nowhere keeps only its identifying columns, and its
    summary moves to ``original_summary``.
    """
    if budget is None or budget <= 0:
        return df
    full = _row_tokens(df.schema, None, summed=True)
    # One struct of step and size: the first step that fits ends the evaluation.
    tried = [F.when(full <= budget, F.struct(F.lit(-1).alias("most"), full.alias("tokens")))]
    for most in LADDER:
        size = _row_tokens(df.schema, most, summed=True)
        tried.append(F.when(size <= budget, F.struct(F.lit(most).alias("most"), size.alias("tokens"))))
    tried.append(F.struct(F.lit(0).alias("most"), full.alias("tokens")))
    sized = _with_item_sizes(df).withColumn("_step", F.coalesce(*tried))
    most = F.col("_step.most")
    unchanged, given_up = most == -1, most == 0
    columns = []
    for f in df.schema.fields:
        value = F.col(f.name)
        if _has_list(f.dataType):
            value = F.when(unchanged, value).otherwise(_cut(value, f.dataType, F.greatest(most, F.lit(1))))
        if f.name not in FALLBACK_KEYS:
            value = F.when(~given_up, value)
        columns.append(value.alias(f.name))
    if "summary" in df.columns and isinstance(df.schema["summary"].dataType, T.StructType):
        columns.append(F.when(given_up, F.col("summary")).alias("original_summary"))
    mark = F.struct(
        F.lit(True).alias("applied"),
        F.lit(budget).cast("long").alias("token_budget"),
        F.col("_step.tokens").alias("estimated_tokens"),
        most.cast("long").alias("list_max_items"),
    )
    return sized.select(*columns, F.when(~unchanged, mark).alias("_truncation"))


def context_pack(df: DataFrame, key: str, order: str, text: str, budget: int) -> DataFrame:
    """Which texts of each key fit a token budget, taken in order."""
    chars = jsonsize.json_chars(F.col(text), T.StringType())
    # Three numbers per text, written once, so that the texts are read once.
    sized = session.stored(df.select(key, order, jsonsize.tokens(chars).alias("tokens")), "sizes")
    packed = sliding.running_sum(sized, key, order, "tokens", "running_tokens")
    return packed.withColumn("fits", F.col("running_tokens") <= budget)


# --- pages of lists -----------------------------------------------------------

def _paged(column: Column, dtype: T.DataType, path: str, page: int, size: int, infos: list) -> Column:
    if isinstance(dtype, T.ArrayType):
        total = F.size(column).cast("long")
        pages = F.greatest(F.lit(1), F.ceil(total / F.lit(size))).cast("long")
        at = F.least(F.lit(page).cast("long"), pages)
        infos.append((path, column.isNotNull(), F.struct(
            at.alias("page"), F.lit(size).cast("long").alias("page_size"),
            total.alias("total_items"), pages.alias("total_pages"),
        )))
        return F.slice(column, ((at - 1) * size + 1).cast("int"), F.lit(size))
    if isinstance(dtype, T.StructType) and _has_list(dtype):
        fields = [_paged(column[f.name], f.dataType, f"{path}.{f.name}", page, size, infos).alias(f.name) for f in dtype.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    return column


def page_lists(df: DataFrame, page: object = 1, page_size: object = paging.DEFAULT_PAGE_SIZE) -> DataFrame:
    """The same page of every list in a row, with one page block per list path."""
    number, size = paging.normalise(page, page_size)
    infos: list = []
    columns = [_paged(F.col(f.name), f.dataType, f"root.{f.name}", number, size, infos).alias(f.name) for f in df.schema.fields]
    if not infos:
        return df
    entries = F.filter(
        F.array(*[F.when(there, F.struct(F.lit(path).alias("key"), info.alias("value"))) for path, there, info in infos]),
        lambda e: e.isNotNull(),
    )
    block = F.struct(
        F.lit(number).cast("long").alias("page"), F.lit(size).cast("long").alias("page_size"),
        F.map_from_entries(entries).alias("lists"),
    )
    return df.select(*columns, block.alias("_pagination"))


# --- views --------------------------------------------------------------------

def top_queries_view(rows: DataFrame, view: str) -> DataFrame:
    """``full`` rows, rows with compact text (``standard``), or one header (``summary``)."""
    if view == "full":
        return rows
    if view == "summary":
        return rows.agg(
            F.count(F.lit(1)).alias("queries"),
            F.max("metric_value").alias("highest_metric"),
            F.sum("count_executions").alias("count_executions"),
        )
    return rows.withColumn("query_sql_text", formats.compact_text(F.col("query_sql_text")))


def table_health_view(docs: DataFrame, view: str) -> DataFrame:
    """Health documents in full, with ten indexes and statistics, or as counts."""
    if view == "full":
        return docs
    if view == "summary":
        count = lambda c: F.greatest(F.size(F.coalesce(F.col(c), F.array())), F.lit(0)).cast("long")
        return docs.select(
            "table_name",
            "table_info",
            F.struct(
                count("indexes").alias("indexes_count"),
                count("foreign_keys").alias("foreign_keys_count"),
                count("statistics_sample").alias("statistics_count"),
                count("constraint_issues").alias("constraint_issues_count"),
                count("recommendations").alias("recommendations_count"),
            ).alias("health_summary"),
            "recommendations",
        )
    cut = {c: F.slice(c, 1, HEALTH_ROWS) for c in ("indexes", "statistics_sample")}
    return docs.withColumns(cut)


def logical_model_view(docs: DataFrame, view: str) -> DataFrame:
    """Model documents in full, with short lists, or as summary with samples."""
    if view == "full":
        return docs
    if view == "summary":
        return docs.select(
            "summary",
            F.slice("relationships", 1, MODEL_RELATIONSHIPS).alias("sample_relationships"),
            F.transform_values(F.col("recommendations"), lambda _, v: F.slice(v, 1, MODEL_RECOMMENDATIONS)).alias("recommendations"),
        )
    entities = F.transform("entities", lambda e: e.withField("attributes", F.slice(e["attributes"], 1, MODEL_ROWS)))
    issues = F.transform_values(F.col("issues"), lambda _, v: F.slice(v, 1, MODEL_ROWS))
    return docs.withColumns({"entities": entities, "issues": issues})


def shape_result(
    docs: DataFrame,
    token_limit: int | None = None,
    fields: str | None = None,
    page: object = 1,
    page_size: object = paging.DEFAULT_PAGE_SIZE,
) -> DataFrame:
    """Budget, then projection, then pages: a page shows what the budget left over."""
    return page_lists(field_projection(token_budget(docs, token_limit), fields), page, page_size)
