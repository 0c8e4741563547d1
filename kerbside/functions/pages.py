"""Reading items out of JSON page bodies.

A page is parsed in two steps. The first step keeps every element of the item array as JSON text, the
second parses one element against a schema whose leaves are all strings. An element of the wrong shape
then spoils only itself, never its page.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DOCUMENT = ""  # path of a body that is itself the array


def page_schema(paths: Iterable[str], root: Iterable[str] = ()) -> str:
    """DDL of a page that holds an item array under each of ``paths`` and text fields named ``root``."""
    tree: dict = {name: "string" for name in root}
    for path in paths:
        node = tree
        *parents, leaf = path.split(".")
        for name in parents:
            node = node.setdefault(name, {})
        node[leaf] = "array<string>"

    def ddl(node: dict | str) -> str:
        if isinstance(node, str):
            return node
        return "struct<" + ",".join(f"{name}:{ddl(child)}" for name, child in node.items()) + ">"

    return ddl(tree)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated a single time however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _on_items(paths: Sequence[str], root: Sequence[str], use: Callable[[Column, Column], Column]) -> Column:
    """``use(items, page)`` on a page that is parsed once."""
    if list(paths) == [DOCUMENT]:
        return once(F.from_json("content", "array<string>"), lambda items: use(items, items))

    def found(page: Column, path: str) -> Column:
        for name in path.split("."):
            page = page[name]
        return page

    return once(
        F.from_json("content", page_schema(paths, root)),
        lambda page: use(F.coalesce(*[found(page, path) for path in paths]), page),
    )


def _explode(pages: DataFrame, paths: Sequence[str], keep: Sequence[str], root: Sequence[str],
             element: Callable[[Column], Column]) -> DataFrame:
    # Page and elements are parsed inside the exploded expression. As columns of their own they would be
    # parsed again by every filter that is pushed below them.
    rows = _on_items(
        paths,
        root,
        lambda items, page: F.transform(
            items, lambda text: F.struct(element(text).alias("item"), *[page[name].alias(name) for name in root])
        ),
    )
    exploded = pages.select(*keep, F.explode(rows).alias("row"))
    return exploded.select(*keep, *[f"row.{name}" for name in root], "row.item").where(F.col("item").isNotNull())


def explode_items(
    pages: DataFrame, paths: Sequence[str], keep: Sequence[str] = (), root: Sequence[str] = ()
) -> DataFrame:
    """One row per array element, taken from the first of ``paths`` that holds an array.

    ``keep`` are page columns carried along, ``root`` are page-level text fields. Pages without an
    array, or with an empty one, give no row; JSON ``null`` elements are dropped.
    """
    return _explode(pages, paths, keep, root, lambda text: text)


def parse_items(
    pages: DataFrame, paths: Sequence[str], schema: str, keep: Sequence[str] = (), root: Sequence[str] = ()
) -> DataFrame:
    """``explode_items`` with each element parsed into a struct column named ``item``."""
    return _explode(pages, paths, keep, root, lambda text: F.from_json(text, schema))


def unreadable_pages(pages: DataFrame, paths: Sequence[str], keep: Sequence[str] = ("filename",)) -> DataFrame:
    """Pages that carry text but no item array under any path: the quarantine report."""
    missing = _on_items(paths, (), lambda items, page: items.isNull())
    return pages.where(F.col("content").isNotNull() & missing).select(*keep)


def unreadable_items(pages: DataFrame, paths: Sequence[str], schema: str, keep: Sequence[str] = ("filename",)) -> DataFrame:
    """Elements that hold none of the fields of ``schema``, as text: they give a row of NULLs or none at all."""
    return explode_items(pages, paths, keep).where(F.coalesce(F.to_json(F.from_json("item", schema)), F.lit("{}")) == "{}")


def first_item(items: Column) -> Column:
    """First element, NULL for an empty or missing array."""
    return F.get(items, F.lit(0))


def last_item(items: Column) -> Column:
    """Last element, NULL for an empty or missing array."""
    return F.try_element_at(items, F.lit(-1))


def geojson_lon(coordinates: Column) -> Column:
    return F.get(coordinates, F.lit(0))


def geojson_lat(coordinates: Column) -> Column:
    return F.get(coordinates, F.lit(1))


def convert(text: Column, kind: str, strict: bool = True) -> Column:
    """Cast JSON text to ``kind``. Bad text fails the job when strict, becomes NULL otherwise."""
    return text.cast(kind) if strict else text.try_cast(kind)


def content_hash(content: Column) -> Column:
    """md5 of a page's canonical JSON: keys in order at every depth, one space after commas and colons, ASCII.

    Texts, numbers, booleans and nulls keep their kind, by one rule for pages of any size and depth; of a repeated key
    the last value counts. Text that is no JSON, or is nested deeper than the parser goes, is hashed as it stands. The
    built-in functions lose the kind of a value or refuse large pages, so this runs on Arrow batches in Python.
    """

    def canonical(body: str) -> str:
        try:
            return json.dumps(json.loads(body), sort_keys=True)
        except (ValueError, RecursionError):
            return body

    # A local function is sent to the executors with the job.
    def digests(bodies: pa.Array) -> pa.Array:
        texts = (None if body.as_py() is None else canonical(body.as_py()) for body in bodies)
        return pa.array([None if t is None else hashlib.md5(t.encode("utf-8", "surrogatepass")).hexdigest() for t in texts], pa.string())

    return F.arrow_udf(digests, "string")(content)


def next_link(content: Column) -> Column:
    """Address of the following page, NULL on the last page and on bodies that are arrays."""
    return F.get_json_object(content, "$.links.next")
