"""Deeply nested JSON to flat related tables by shared inlining.

The schema graph of the data itself decides the tables: elements that are repeated, shared by
several parents or recursive get a table of their own with a key to their parent's row; single
descendants become columns of the table above them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alinea.functions.clean import strip
from alinea.workspace import materialize

ROOT = "document"


def _bare(text: Column) -> Column:
    return F.regexp_replace(text, r"^[\s\x{feff}]+", "")


def read_document(payload: Column) -> Column:
    """The payload as a variant; null if it isn't readable JSON.

    A byte order mark is dropped. JSON that is wrapped as a JSON string is unwrapped as often as it is
    wrapped: each time doubles the escape signs, so the length of the text bounds how often that can be.
    """
    text = _bare(payload)
    most = F.when(text.startswith('"'), F.sequence(F.lit(1), F.ceil(F.log2(F.length(text))).cast("int") + 2)).otherwise(F.array().cast("array<int>"))
    unwrapped = lambda t: F.coalesce(_bare(F.try_variant_get(F.try_parse_json(t), "$", "string")), F.lit(""))
    return F.try_parse_json(F.aggregate(most, text, lambda t, _: F.when(t.startswith('"'), unwrapped(t)).otherwise(t)))


def _is_object(v: Column) -> Column:
    """True for an object: any can be read as one without known members, and nothing else can."""
    return F.try_variant_get(v, "$", "struct<`~`:string>").isNotNull()


@dataclass
class Shape:
    """The schema graph: what was seen of each element, and the tables that follow from it."""

    parents: dict[str, set[str]] = field(default_factory=dict)
    repeated: set[str] = field(default_factory=set)
    objects: set[str] = field(default_factory=set)

    def ancestors(self, name: str) -> set[str]:
        seen: set[str] = set()
        todo = [name]
        while todo:
            for p in self.parents.get(todo.pop(), ()):
                if p not in seen:
                    seen.add(p)
                    todo.append(p)
        return seen

    def needs_table(self, name: str) -> bool:
        """Repeated, recursive, or an object under several parents. Scalars are columns otherwise."""
        shared = name in self.objects and len(self.parents.get(name, ())) > 1
        return name in self.repeated or shared or name in self.ancestors(name)

    def inlined(self, table: str) -> list[tuple[str, ...]]:
        """Paths below a table's element that become its columns."""
        out: list[tuple[str, ...]] = []
        todo = [(c,) for c, ps in sorted(self.parents.items()) if table in ps and not self.needs_table(c)]
        while todo:
            path = todo.pop(0)
            if path[-1] in self.objects:
                todo += [(*path, c) for c, ps in sorted(self.parents.items()) if path[-1] in ps and not self.needs_table(c)]
            out.append(path)
        return out


@dataclass
class Shredded:
    shape: Shape
    levels: list[tuple[set[str], DataFrame]]
    documents: DataFrame

    def rejects(self) -> DataFrame:
        """(doc_id, reason) of each payload that gave no rows: ``empty``, ``unreadable`` or ``no object``."""
        v = read_document(F.col("payload"))
        blank = F.coalesce(strip(F.col("payload")) == "", F.lit(True))
        reason = F.when(blank, "empty").when(v.isNull(), "unreadable").when(~_is_object(v), "no object")
        return self.documents.select("doc_id", reason.alias("reason")).filter("reason is not null")

    def table(self, name: str, *fields: str) -> DataFrame:
        """The table of an element: doc_id, discriminating key, own position, parent link, columns.

        ``path`` and ``places`` are the names and positions from the top down to the row; with
        doc_id and entry they are its key. The parent's key is the same without the last of each, as
        ``parent`` names its element. ``value`` is the text of an element given as a bare scalar.
        """
        # Only the levels that hold the element are read; one that none holds has an empty table.
        parts = [level.filter(F.col("element") == name) for names, level in self.levels if name in names] or [self.levels[0][1].filter(F.lit(False))]
        rows = parts[0]
        for more in parts[1:]:
            rows = rows.unionByName(more)
        paths = self.shape.inlined(name)
        paths += [(f,) for f in fields if (f,) not in paths]
        columns = [F.try_variant_get("node", "$" + "".join(f"['{p}']" for p in path), "string").alias("_".join(path)) for path in paths]
        return rows.select("doc_id", "entry", "element", "parent", "path", "places", F.element_at("places", -1).alias("position"), F.when(~F.col("is_object"), F.try_variant_get("node", "$", "string")).alias("value"), *columns)


def _exploded(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with (pos, key, value) of each item or member of a variant, one row of nulls for any other value.

    The values are slices of the variant's bytes; a cast to a list or map would build each of them anew.
    """
    return rows.lateralJoin(rows.sparkSession.tvf.variant_explode_outer(F.col(column).outer()))


def _lists(level: DataFrame) -> DataFrame:
    """A level's rows (path, places, element, w, …): one per element of each list ``w``, with its place."""
    rows = _exploded(level, "w")
    listed = F.col("pos").isNotNull() & F.col("key").isNull()
    # Of an object only its first member's row stays, and stands for the object; an empty list has none.
    empty_list = F.col("pos").isNull() & F.try_variant_get("w", "$", "array<variant>").isNotNull()
    rows = rows.filter(listed | ((F.coalesce("pos", F.lit(0)) == 0) & ~empty_list))
    place = F.when(listed, F.col("pos")).otherwise(0)
    rows = rows.select("doc_id", "entry", "element", "parent", "path", F.concat("places", F.array(place)).alias("places"), listed.alias("listed"), F.when(listed, F.col("value")).otherwise(F.col("w")).alias("node"))
    # A variant null holds a place but is no row.
    return rows.filter(~F.is_variant_null("node")).withColumn("is_object", _is_object(F.col("node")))


def shred(docs: DataFrame, doc_id: str, payload: str, entry: str = "entry", most_names: int = 10_000) -> Shredded:
    """Take apart ``payload``: level by level, each written once and read by the next.

    The members of the top object are entries of one kind, told apart by their key (column ``entry``
    of all tables; element name ``entry``). Lists are counted from 0 with every element; an object
    given without its list has position 0. Null elements keep their position but give no row.
    Unreadable, null and blank payloads give no rows; ``Shredded.rejects`` lists them. The graph is
    read off all documents; only its distinct edges, as many as there are member names, reach the
    driver. More than ``most_names`` of them at one level raise an error: an object whose members are
    keyed by data belongs at the top.
    """
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(payload).alias("payload"))
    top = _exploded(read.select("doc_id", read_document(F.col("payload")).alias("document")), "document").filter("key is not null").select("doc_id", F.col("key").alias("entry"), F.col("value").alias("w"))
    level = top.select("doc_id", "entry", F.lit(entry).alias("element"), F.lit(ROOT).alias("parent"), F.array(F.lit(entry)).alias("path"), F.array().cast("array<int>").alias("places"), "w")
    shape, levels = Shape(), []
    while True:
        table = materialize(_lists(level), f"level{len(levels)}")
        edges = table.groupBy("parent", "element").agg(F.max("listed").alias("listed"), F.max("is_object").alias("is_object")).limit(most_names + 1).collect()
        if len(edges) > most_names:
            raise ValueError(f"more than {most_names} member names at one level")
        if edges or not levels:
            levels.append(({e["element"] for e in edges}, table))
        if not edges:
            break
        for e in edges:
            shape.parents.setdefault(e["element"], set()).add(e["parent"])
            if e["listed"]:
                shape.repeated.add(e["element"])
            if e["is_object"]:
                shape.objects.add(e["element"])
        inner = _exploded(table.filter("is_object").select("doc_id", "entry", F.col("element").alias("parent"), "path", "places", "node"), "node").filter("key is not null")
        level = inner.select("doc_id", "entry", "parent", F.concat("path", F.array("key")).alias("path"), "places", F.col("key").alias("element"), F.col("value").alias("w"))
    return Shredded(shape, levels, read)
