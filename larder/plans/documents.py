"""Item contents and the build of a serving table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame

from larder.operators import aggregates, filters, joins
from larder.sources import schemas
from larder.sources.serving import ServingTable


def item_content(
    tags: DataFrame, accounts: DataFrame, condition: str, account: str, category: str, tag: str, out: str = "tag_names"
) -> DataFrame:
    """Sorted tag text per item and category, for all categories in one pass.

    ``accounts`` is attached by a left join, as further account columns may be
    part of ``condition``; it must be unique per account.
    """
    rows = joins.attach(tags, accounts, account).filter(condition)
    return aggregates.sorted_tag_text(rows, [account, category], tag, out)


def write_item_content(content: DataFrame, path: str, category: str, wanted: Sequence[Any] | None = None) -> None:
    filters.write_category_slices(content, path, category, wanted)


def serving_publish(
    table: ServingTable,
    id_sets: Mapping[str, DataFrame],
    documents: Sequence[DataFrame],
    fields: Sequence[str],
    defaults: Mapping[str, Any] | None = None,
    version: str | None = None,
    keep: int | None = None,
) -> DataFrame:
    """Merge documents, project them, write a version, publish it, read it.

    The pointer moves only after the write is complete.
    """
    merged = joins.merge_documents(id_sets, documents)
    docs = schemas.conform(merged, fields, defaults)
    table.publish(table.write(docs, "full", version), keep)
    return table.read()
