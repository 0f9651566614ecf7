"""Nested documents to rows.

A document table has real columns for the keys people filter on (``_id``, ``number``, ``created``) and one JSON text
column ``doc``. A document is parsed once, to a variant, and everything below is taken from that: nothing is parsed
again and nothing is shuffled.

Numbers keep all their digits: a leaf is the number in plain notation, without trailing zeros behind the point
(``100000000.00`` is ``100000000``). Numbers with an exponent, or of more than 38 digits, are read as doubles. Objects and
lists at a leaf are JSON text with keys in order. A document with a key twice in one object is malformed, unless
``spark.sql.variant.allowDuplicateKeys`` is set; then the last one counts.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmart.contracts import NUMBER_COLUMNS, Entity
from loanmart.session import settled


# -- paths ------------------------------------------------------------------------------------------------------------

def steps(path: str) -> list[str]:
    """The keys of a dotted path; a key that holds a dot is written in backquotes."""
    return [quoted or plain for quoted, plain in re.findall(r"`([^`]*)`|([^.`]+)", path)]


def _step(key: str) -> str:
    return f"`{key}`" if "." in key else key


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _tree(paths: Iterable[str]) -> dict:
    tree: dict = {}
    for path in sorted(set(paths), key=lambda p: len(steps(p))):
        node = tree
        *inner, leaf = steps(path)
        for name in inner:
            node = node.setdefault(name, {})
            if node is None:
                raise ValueError(f"{path} runs below a path that is read whole")
        node.setdefault(leaf, None)
    return tree


def path_schema(paths: Iterable[str], whole: Iterable[str] = ()) -> T.StructType:
    """The narrowest schema that holds all paths: text leaves, variants for the paths in ``whole``."""
    kinds = {tuple(steps(p)): T.VariantType() for p in whole}

    def build(node: dict, above: tuple) -> T.StructType:
        return T.StructType([
            T.StructField(k, kinds.get((*above, k), T.StringType()) if v is None else build(v, (*above, k))) for k, v in node.items()
        ])

    return build(_tree([*paths, *whole]), ())


def _ddl(kind: T.DataType) -> str:
    if isinstance(kind, T.StructType):
        return f"struct<{','.join(f'{_quoted(f.name)}:{_ddl(f.dataType)}' for f in kind.fields)}>"
    return kind.simpleString()


def _texts(fields: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


def read_object(value: Column | str, schema: T.StructType) -> Column:
    """A variant as a struct; null where it is no object. A field that is missing or does not fit is null."""
    return F.try_variant_get(value, "$", _ddl(schema))


def as_list(value: Column | str) -> Column:
    """The elements of a variant list; null for anything else."""
    return F.try_variant_get(value, "$", "array<variant>")


def is_object(value: Column | str) -> Column:
    return F.try_variant_get(value, "$", "struct<>").isNotNull()


def as_text(value: Column | str) -> Column:
    """A variant's text; JSON null gives null, an object or a list its JSON text."""
    return F.try_variant_get(value, "$", "string")


def _ref(root: str, path: str) -> str:
    return ".".join([root, *[f"`{p}`" for p in steps(path)]])


def _at(root: str, path: str) -> Column:
    return F.col(_ref(root, path))


def _place(path: str) -> str:
    return "$" + "".join(f"['{p}']" if '"' in p else f'["{p}"]' for p in steps(path))


def json_path(doc: Column | str, path: str) -> Column:
    """One dotted path as text; null when any step is missing or no object."""
    return F.try_variant_get(F.try_parse_json(doc), _place(path), "string")


def path_exists(doc: Column | str, path: str) -> Column:
    """True when the path is present, also when its value is JSON null."""
    return F.try_variant_get(F.try_parse_json(doc), _place(path), "variant").isNotNull()


def select_paths(docs: DataFrame, paths: Mapping[str, str], keep: Iterable[str] = (), doc: str = "doc") -> DataFrame:
    """Read many paths with one parse: ``{output column: dotted path}``, all as text."""
    keep = list(keep)
    parsed = docs.select(*keep, read_object(F.try_parse_json(doc), path_schema(paths.values())).alias("_d"))
    return parsed.selectExpr(*[f"`{c}`" for c in keep], *[f"{_ref('_d', p)} as {_quoted(out)}" for out, p in paths.items()])


# -- one or many ------------------------------------------------------------------------------------------------------

def items(container: Column | str) -> Column:
    """The elements of a one-or-many variant; null, JSON null and blank text give null.

    Anything but a list is one element. A text that holds a list or an object is opened as well.
    """
    container = F.col(container) if isinstance(container, str) else container
    text = F.btrim(as_text(container), F.lit(" \t\r\n"))
    inner = F.coalesce(F.when(text.startswith("[") | text.startswith("{"), F.try_parse_json(text)), container)
    one = F.when(text != "", F.coalesce(as_list(inner), F.array(inner)))
    return F.coalesce(as_list(container), F.when(is_object(container), F.array(container)).otherwise(one))


def _container(text: Column | str) -> Column:
    """Text as a variant: what it holds if it is JSON, else the text itself."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.try_parse_json(text), text.cast("variant"))


def elements(container: Column | str) -> Column:
    """The elements of a one-or-many container given as text, each as text; anything but a list is one element.

    Null, blank and JSON null give null.
    """
    return F.transform(items(_container(container)), lambda x: F.coalesce(as_text(x), F.lit("null")))


def one_or_many(container: Column | str, fields: Iterable[str]) -> Column:
    """JSON text of one object or a list as an array of its objects; null, blank and absent give null."""
    schema = _texts(fields)
    return F.filter(F.transform(items(_container(container)), lambda x: read_object(x, schema)), lambda x: x.isNotNull())


def any_element(container: Column | str, fields: Iterable[str], test) -> Column:
    """True when some object of a one-or-many container passes ``test(element)``; other elements are passed over."""
    return F.coalesce(F.exists(one_or_many(container, fields), test), F.lit(False))


def containers(docs: DataFrame, entities: Iterable[Entity], path: str | None = None) -> DataFrame:
    """Parent values (``_s_<source>``) and children (``_r_<path>``, variants) of several entities, from one parse.

    ``_k_<key>`` are the document's own keys and ``_bad`` its text where it is no JSON object, for rejects.
    """
    entities = list(entities)
    sources = list(dict.fromkeys(p for e in entities for p in e.parents.values()))
    paths = list(dict.fromkeys(path or e.path for e in entities))
    inside = [p for p in sources if p not in docs.columns]
    parsed = docs.select(
        *[F.col(p).alias(f"_s_{p}") for p in sources if p not in inside],
        *[F.col(c).alias(f"_k_{c}") for c in ("_id", "number") if c in docs.columns],
        "doc", read_object(F.try_parse_json("doc"), path_schema(inside, paths)).alias("_d"),
    )
    return parsed.select(
        *[F.col(f"`{c}`") for c in parsed.columns if c not in ("_d", "doc")],
        F.when(F.col("_d").isNull(), F.col("doc")).alias("_bad"),
        *[_at("_d", p).alias(f"_s_{p}") for p in inside],
        *[_at("_d", p).alias(f"_r_{p}") for p in paths],
    )


def unnest(docs: DataFrame, entity: Entity, path: str | None = None) -> DataFrame:
    """Explode an entity's child into rows that follow its column contract.

    Two-level entities accept every container shape: one object or a list, at the wrapper and at the child.
    """
    return only_rows(unnest_tagged(docs, entity, path))


def unnest_rejects(docs: DataFrame, entity: Entity, path: str | None = None) -> DataFrame:
    """What :func:`unnest` cannot read: ``_id``, ``number``, ``entity``, ``reason``, ``raw``."""
    return only_rejects(unnest_tagged(docs, entity, path), entity)


def unnest_split(docs: DataFrame, entity: Entity, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows and rejects of an entity. Every element of every level is either opened or rejected with its text."""
    return split_container(containers(docs, [entity], path), entity, path)


def split_container(opened: DataFrame, entity: Entity, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows and rejects of one entity from the output of :func:`containers`."""
    tagged = tag_container(opened, entity, path)
    return only_rows(tagged), only_rejects(tagged, entity)


def only_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("reason").isNull()).select("row.*")


def only_rejects(tagged: DataFrame, entity: Entity) -> DataFrame:
    return tagged.where(F.col("reason").isNotNull()).select("key.*", F.lit(entity.name).alias("entity"), "reason", "raw")


def unnest_tagged(docs: DataFrame, entity: Entity, path: str | None = None) -> DataFrame:
    """Rows and rejects of an entity in one pass; see :func:`tag_container`."""
    return tag_container(containers(docs, [entity], path), entity, path)


def tag_container(opened: DataFrame, entity: Entity, path: str | None = None) -> DataFrame:
    """One row for each element of the entity, opened or rejected, from the output of :func:`containers`.

    ``reason`` is null for rows; ``raw`` is a reject's text; ``key`` has the document's keys, ``row`` the entity's columns.
    """
    made = {c: entity.rename.get(c, c) for c in entity.columns}
    if not entity.child_wins:
        made = {c: f for c, f in made.items() if c not in entity.parents and c not in entity.carry}
    fields = list(dict.fromkeys(made.values()))
    keys = [c for c in opened.columns if c.startswith("_k_")]
    none = F.lit(None).cast("string")
    rows = opened.select(
        *keys, *[F.col(f"`_s_{p}`").alias(f"_p_{out}") for out, p in entity.parents.items()],
        F.when(F.col("_bad").isNotNull(), "malformed document").alias("_reason"), F.col("_bad").alias("_raw"),
        F.col(f"`_r_{path or entity.path}`").alias("_c"),
    )

    def opened_by(frame: DataFrame, schema: T.StructType, reason: str) -> DataFrame:
        """One row for each element of ``_c``, read as ``_o``, or rejected; what is rejected already goes through."""
        held = [c for c in frame.columns if c not in ("_reason", "_raw", "_c")]
        gone = F.array(F.struct(F.col("_reason").alias("reason"), F.col("_raw").alias("raw"), F.lit(None).cast("variant").alias("e")))
        each = F.transform(items("_c"), lambda e: F.struct(none.alias("reason"), none.alias("raw"), e.alias("e")))
        one = frame.select(*held, F.explode(F.when(F.col("_reason").isNotNull(), gone).otherwise(each)).alias("_x"))
        read = one.select(*held, "_x", read_object("_x.e", schema).alias("_o"))
        bad = F.col("_x.reason").isNull() & F.col("_o").isNull()
        return read.select(*held, F.when(bad, reason).otherwise(F.col("_x.reason")).alias("_reason"),
                           F.when(bad, F.coalesce(as_text("_x.e"), F.lit("null"))).otherwise(F.col("_x.raw")).alias("_raw"), "_o")

    if entity.nested:
        wrapper, child = entity.nested
        rows = opened_by(rows, path_schema(dict.fromkeys(map(_step, entity.carry.values())), [_step(wrapper)]), "unreadable child")
        kept = [c for c in rows.columns if c != "_o"]
        rows = rows.select(*kept, *[_at("_o", _step(f)).alias(f"_p_{out}") for out, f in entity.carry.items()], _at("_o", _step(wrapper)).alias("_c"))
        rows = opened_by(rows, path_schema([], [_step(child)]), "unreadable wrapper")
        rows = rows.withColumn("_c", _at("_o", _step(child))).drop("_o")
    rows = opened_by(rows, _texts(fields), "unreadable child")

    def value(c: str) -> str:
        options = [f"_o.`{made[c]}`"] if c in made else []
        if f"_p_{c}" in rows.columns:
            options.append(f"cast(`_p_{c}` as string)")
        out = f"coalesce({', '.join(options)})" if options else "cast(null as string)"
        return f"{f'try_cast({out} as bigint)' if c in NUMBER_COLUMNS else out} as `{c}`"

    return rows.select(F.col("_reason").alias("reason"), F.col("_raw").alias("raw"), F.struct(*[F.col(k).alias(k[3:]) for k in keys]).alias("key"),
                       F.struct(*[F.expr(value(c)) for c in entity.output]).alias("row"))


# -- shaping ----------------------------------------------------------------------------------------------------------

def _as_text(name: str, dtype: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    return F.to_json(c) if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)) else c.cast("string")


def conform(df: DataFrame, columns: Iterable[str], essential: Iterable[str] = ()) -> DataFrame:
    """Fixed columns in fixed order: absent ones become null, extra ones go, values become text (numbers for keys)."""
    columns = list(columns)
    columns += [c for c in essential if c not in columns]
    types = {f.name: f.dataType for f in df.schema.fields}

    def shaped(c: str) -> Column:
        if c not in types:
            return F.lit(None).cast("bigint" if c in NUMBER_COLUMNS else "string").alias(c)
        text = _as_text(c, types[c])
        return (text.try_cast("bigint") if c in NUMBER_COLUMNS else text).alias(c)

    return df.select(*[shaped(c) for c in columns])


def drop_nested(df: DataFrame) -> DataFrame:
    """Keep columns with atomic values only."""
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    return df.select(*[F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, nested)])


def flatten_prefix(df: DataFrame, sep: str = "_") -> DataFrame:
    """Struct columns become ``parent_child`` columns at the end, lists become text joined by ``', '``."""

    def leaves(c: Column, dtype: T.StructType, name: str, joint: str):
        for f in dtype.fields:
            inner, label = c.getField(f.name), f"{name}{joint}{f.name}"
            if isinstance(f.dataType, T.StructType):
                yield from leaves(inner, f.dataType, label, ".")
            else:
                yield inner.alias(label)

    flat, added = [], []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StructType):
            added.extend(leaves(c, f.dataType, f.name, sep))
        elif isinstance(f.dataType, T.ArrayType):
            atomic = not isinstance(f.dataType.elementType, (T.StructType, T.ArrayType, T.MapType))
            text = F.transform(c, lambda x: x.cast("string") if atomic else F.to_json(x))  # noqa: B023
            flat.append(F.array_join(text, ", ").alias(f.name))
        else:
            flat.append(c)
    return df.select(*flat, *added)


def discover_paths(docs: DataFrame, doc: str = "doc") -> list[str]:
    """All dotted paths that occur. Lists count as leaves.

    They become columns, so their number must fit into a schema; :func:`path_values` needs no such list and takes
    documents whose keys are ids.
    """
    return sorted(r["path"] for r in path_values(docs, doc=doc).select("path").distinct().collect())


def flatten_paths(docs: DataFrame, keep: Iterable[str] = (), doc: str = "doc",
                  paths: Iterable[str] | None = None) -> DataFrame:
    """One column per dotted path; lists are kept whole as JSON text."""
    paths = list(paths) if paths is not None else discover_paths(docs, doc)
    return select_paths(docs, {p: p for p in paths}, keep, doc)


#: Levels opened in one job; a deeper document takes further jobs.
LEVELS = 8


def _descend(docs: DataFrame, keep: list[str], v: Column, done: Callable[[Column, Column], Column],
             at: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Open ``v`` level by level until nothing is left to open; ``keep`` and the ``_v``, ``_at`` of what was found.

    ``done`` tells from a piece's key (null in lists) and value whether it is found, ``at`` gives its place from the place
    above and its key. A piece is taken out as it stands, not built anew, and values with nothing inside end there.
    ``LEVELS`` levels are one narrow plan; what is then still open is written and taken up by the next.
    """
    spark, none = docs.sparkSession, F.lit(None).cast("string")
    held = {c: f"_k{i}" for i, c in enumerate(keep)}
    frame = docs.select(*[F.col(c).alias(k) for c, k in held.items()], F.lit(False).alias("_done"), none.alias("_at"), v.alias("_v"))
    found = None
    while True:
        for _ in range(LEVELS):
            # what is found goes through as one row
            each = spark.tvf.variant_explode_outer(F.when(~F.col("_done").outer(), F.col("_v").outer()))
            place = at(F.col("_at"), F.col("key")) if at else F.col("_at")
            frame = frame.lateralJoin(each).where(F.col("_done") | F.col("pos").isNotNull()).select(
                *held.values(), (F.col("_done") | F.coalesce(done(F.col("key"), F.col("value")), F.lit(False))).alias("_done"),
                F.when(F.col("_done"), F.col("_at")).otherwise(place).alias("_at"),
                F.when(F.col("_done"), F.col("_v")).otherwise(F.col("value")).alias("_v"))
        frame = settled(frame.where(F.col("_done") | is_object("_v") | as_list("_v").isNotNull()), "levels")
        part = frame.where("_done").drop("_done")
        found = part if found is None else found.unionByName(part)
        frame = frame.where("not _done")
        if frame.isEmpty():
            return found.select(*[F.col(k).alias(c) for c, k in held.items()], "_at", "_v")


def path_values(docs: DataFrame, keep: Iterable[str] = (), doc: str = "doc", paths: Iterable[str] | None = None) -> DataFrame:
    """``path``, ``value`` (text): a row for each document and dotted path that holds a value; lists are kept whole as JSON text.

    With ``paths`` only those, else all that a document has, whatever its keys: no list of them is made.
    """
    keep = list(keep)
    if paths is not None:
        wide = flatten_paths(docs, keep, doc, paths)
        pairs = [F.struct(F.lit(c).alias("path"), F.col(_quoted(c)).alias("value")) for c in wide.columns if c not in keep]
        return wide.select(*keep, F.inline(F.array(*pairs))).where(F.col("value").isNotNull())

    def at(above: Column, key: Column) -> Column:
        return F.concat_ws(".", above, F.when(key.contains("."), F.concat(F.lit("`"), key, F.lit("`"))).otherwise(key))

    parsed = F.try_parse_json(doc)
    found = _descend(docs, keep, F.when(is_object(parsed), parsed), lambda _, value: ~is_object(value), at)
    return found.select(*keep, F.col("_at").alias("path"), as_text("_v").alias("value")).where("value is not null")


# -- search -----------------------------------------------------------------------------------------------------------

def _mentions(key: str, doc: str) -> Column:
    # a key may be written with escapes, so a document with a backslash has to be read
    written = json.dumps(key, ensure_ascii=False)
    return F.col(doc).contains(written) | F.col(doc).contains("\\")


def key_search(docs: DataFrame, key: str, fields: Iterable[str], keep: Iterable[str] = (),
               doc: str = "doc") -> DataFrame:
    """Every object stored under ``key`` anywhere in a document, with its atomic fields as text.

    Documents that mention the key are opened level by level, to any depth; what stands below a match is not searched.
    """
    keep = list(keep)
    # not a filter: Spark would push it below the making of a derived text, which would then be made again
    parsed = F.try_parse_json(F.when(_mentions(key, doc), F.col(doc)))
    schema = T.StructType([T.StructField(f, T.VariantType()) for f in fields])
    found = _descend(docs, keep, parsed, lambda name, _: name == key)
    each = found.select(*keep, F.explode(F.coalesce(as_list("_v"), F.array("_v"))).alias("_v"))
    hits = each.select(*keep, read_object("_v", schema).alias("_f")).where("_f is not null")

    def atomic(f: str) -> Column:
        value = F.col(f"_f.{_quoted(f)}")
        return F.when(as_list(value).isNull() & ~is_object(value), as_text(value)).alias(f)

    return hits.select(*keep, *[atomic(f) for f in fields])


def key_search_rejects(docs: DataFrame, key: str, keep: Iterable[str] = (), doc: str = "doc") -> DataFrame:
    """Documents :func:`key_search` cannot open: no valid JSON, or nested too deep. ``raw`` holds the text."""
    return docs.where(_mentions(key, doc)).where(F.try_parse_json(doc).isNull()).select(*keep, F.col(doc).alias("raw"))
