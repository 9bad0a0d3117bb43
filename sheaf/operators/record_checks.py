"""Checks over the fields of extraction records: their paths, sections, samples and parameters.

A record is one row with its JSON text. Everything that concerns one record is decided
inside its row, by expressions over its parsed value; only reports over all records shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheaf.functions.binding import let
from sheaf.functions.json_text import strict_variant
from sheaf.functions.text import strip
from sheaf.record_template import (
    FREE, NUMBER, PARAMETERS_MEMBER, POWDER_MEMBER, SAMPLE_MEMBER, SPRAY_SECTION, TECHNIQUE_MEMBER, TECHNIQUES,
    TEMPLATE,
)
from sheaf.session import stage

#: Levels of a record that are unfolded in one pass; deeper values take further passes.
LEVELS = 8
ANY_ITEM = "*"
ABSENT, BROKEN, NULL = "absent", "broken", "null"
_NUMERIC = r"\A\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*\z"


# -- the template as tables --------------------------------------------------------------
def escaped(name: str) -> str:
    """A member name as part of a path: ``/`` separates parts, ``*`` is any item of an array."""
    return "~2" if name == ANY_ITEM else name.replace("~", "~0").replace("/", "~1")


def template_paths(template: Any = None, path: str = "") -> Iterator[tuple[str, str]]:
    """(path, kind) of every value a template names: text, number, object, array or free."""
    template = TEMPLATE if template is None else template
    if isinstance(template, dict):
        yield path, "object"
        for name, value in template.items():
            yield from template_paths(value, f"{path}/{escaped(name)}")
    elif isinstance(template, list):
        yield path, "array"
        yield from template_paths(template[0], f"{path}/{ANY_ITEM}")
    else:
        yield path, template


def template_members(template: Any = None, path: str = "") -> dict[str, list[str]]:
    """Path of each object of a template, and the names of its members."""
    template = TEMPLATE if template is None else template
    if isinstance(template, list):
        return template_members(template[0], f"{path}/{ANY_ITEM}")
    if not isinstance(template, dict):
        return {}
    found = {path: list(template)}
    for name, value in template.items():
        found |= template_members(value, f"{path}/{escaped(name)}")
    return found


# -- values --------------------------------------------------------------------------------
def value_kind(value: Column) -> Column:
    """object, array, text, numeric text, number, boolean, null or (unparsed) broken."""
    kind = F.schema_of_variant(value)
    digits = F.try_variant_get(value, "$", "string").rlike(_NUMERIC)
    return (
        F.when(value.isNull(), BROKEN)
        .when(kind == "VOID", NULL)
        .when(kind == "STRING", F.when(digits, "numeric text").otherwise("text"))
        .when(kind == "BOOLEAN", "boolean")
        .when(kind.startswith("OBJECT"), "object")
        .when(kind.startswith("ARRAY"), "array")
        .otherwise("number")
    )


def counted(items: Column) -> Column:
    """Distinct items of an array and how often each occurs, in order: array of (item, n)."""

    def runs(ordered: Column) -> Column:
        begins = F.filter(
            F.transform(ordered, lambda _, i: i),
            lambda i: (i == 0) | ~F.get(ordered, i).eqNullSafe(F.get(ordered, i - 1)),
        )
        return let(begins, lambda b: F.transform(b, lambda i, k: F.struct(
            F.get(ordered, i).alias("item"),
            (F.coalesce(F.get(b, k + 1), F.size(ordered)) - i).cast("bigint").alias("n"),
        )))

    return let(F.array_sort(items), runs)


def _member_path(path: Column, name: Column) -> Column:
    part = F.when(name == ANY_ITEM, "~2").otherwise(F.replace(F.replace(name, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1")))
    return F.concat(path, F.lit("/"), part)


def _none_of(item: Column) -> Column:
    """An empty array of the item's type."""
    return F.filter(F.array(item), lambda _: F.lit(False))


def _inside(node: Column) -> Column:
    """The values directly inside a value, with their paths."""
    path, value = node["path"], node["value"]
    members = F.try_variant_get(value, "$", "map<string,variant>")
    items = F.try_variant_get(value, "$", "array<variant>")
    return (
        F.when(members.isNotNull(), F.transform(F.map_entries(members), lambda e: F.struct(
            _member_path(path, e["key"]).alias("path"), e["value"].alias("value")
        )))
        .when(items.isNotNull(), F.transform(items, lambda v: F.struct(
            F.concat(path, F.lit("/" + ANY_ITEM)).alias("path"), v.alias("value")
        )))
        .otherwise(_none_of(node))
    )


def _absent(node: Column, wanted: Column) -> Column:
    """Members that the template's object at this path has and the value lacks, as (path, kind)."""
    members = F.try_variant_get(node["value"], "$", "map<string,variant>")
    lacking = F.array_except(F.element_at(wanted, node["path"]), F.map_keys(members))
    return F.coalesce(
        F.transform(lacking, lambda m: F.struct(_member_path(node["path"], m).alias("path"), F.lit(ABSENT).alias("kind"))),
        F.expr("cast(array() as array<struct<path:string,kind:string>>)"),
    )


def _unfolded(nodes: Column, wanted: Column | None, levels: int) -> Column:
    """``found`` (path, kind) of the nodes and what is inside them, and ``rest``: what lies deeper."""

    def seen(level: Column) -> Column:
        own = F.transform(level, lambda x: F.struct(x["path"].alias("path"), value_kind(x["value"]).alias("kind")))
        if wanted is None:
            return own
        return F.concat(own, F.flatten(F.transform(level, lambda x: _absent(x, wanted))))

    def below(level: Column, left: int, found: list[Column]) -> Column:
        found = [*found, seen(level)]
        inner = F.flatten(F.transform(level, _inside))
        if left:
            return let(inner, lambda deeper: below(deeper, left - 1, found))
        rest = F.transform(inner, lambda x: F.struct(x["path"].alias("path"), F.to_json(x["value"]).alias("value")))
        return F.struct(counted(F.concat(*found)).alias("found"), rest.alias("rest"))

    return let(nodes, lambda level: below(level, levels, []))


# -- paths -----------------------------------------------------------------------------------
def field_paths(
    records: DataFrame, text: str = "record_json", template: Any = None, levels: int = LEVELS
) -> DataFrame:
    """Every path of every record: the other columns, ``path``, ``kind``, ``n``.

    Positions in arrays are folded (``/*``), so ``n`` counts values of a kind at a path of
    one record. The root has the path ``''``. Text that is not one JSON value, or null, is
    one row of kind ``broken``; so are objects with repeated members. With a ``template``,
    members that an object should have and lacks are rows of kind ``absent``, which tells
    them from null members. An object the record lacks altogether reports itself, not its
    members. Values may be nested to any depth: ``levels`` are unfolded at a time.
    """
    keep = [c for c in records.columns if c != text]
    wanted = None
    if template is not None:
        wanted = F.create_map(*[
            c for path, names in template_members(template).items()
            for c in (F.lit(path), F.array(*map(F.lit, names)))
        ])
    rows = records.select(
        *keep, F.array(F.struct(F.lit("").alias("path"), strict_variant(text).alias("value"))).alias("_nodes")
    )
    found = None
    while True:
        flat = stage(rows.select(*keep, _unfolded(F.col("_nodes"), wanted, levels).alias("_f")), "paths")
        own = flat.select(*keep, F.explode("_f.found").alias("_i")).select(
            *keep, F.col("_i.item.path").alias("path"), F.col("_i.item.kind").alias("kind"), F.col("_i.n").alias("n")
        )
        found = own if found is None else found.unionByName(own)
        deeper = flat.filter(F.size("_f.rest") > 0)
        if deeper.isEmpty():
            return found
        rows = deeper.select(*keep, F.transform("_f.rest", lambda x: F.struct(
            x["path"].alias("path"), F.parse_json(x["value"]).alias("value")
        )).alias("_nodes"))


def template_table(spark: SparkSession, template: Any = None) -> DataFrame:
    return spark.createDataFrame(list(template_paths(template)), "path string, kind string")


def path_faults(paths: DataFrame, template: Any = None) -> DataFrame:
    """``fault`` absent, foreign or shape per path, from :func:`field_paths` with the same template.

    A foreign path is a member that the template's object lacks; what is inside a foreign
    value is not reported again, nor is anything inside a free object. The shape is wrong
    where an object or array should be and something else but null is, a broken record
    included, or where one is that should be a single value.
    """
    known = template_table(paths.sparkSession, template)
    # the template is a constant of some hundred rows
    parents = F.broadcast(known.filter("kind = 'object'").select(F.col("path").alias("_parent")))
    parent = F.regexp_replace("path", r"/[^/]*\z", "")
    own = [c for c in paths.columns if c not in ("kind", "n")]
    absent = paths.filter(F.col("kind") == ABSENT).withColumn("fault", F.lit(ABSENT))
    foreign = (
        paths.filter((F.col("kind") != ABSENT) & (F.col("path") != ""))
        .join(F.broadcast(known.select("path")), "path", "left_anti")
        .join(parents, parent == F.col("_parent"), "left_semi")
        .withColumn("fault", F.lit("foreign"))
    )
    wanted = F.when(F.col("_kind") == FREE, "object").otherwise(F.col("_kind"))
    both = ("object", "array")
    shape = (
        paths.join(F.broadcast(known.withColumnRenamed("kind", "_kind")), "path")
        .filter(F.when(wanted.isin(*both), ~F.col("kind").isin(NULL, ABSENT) & (F.col("kind") != wanted))
                .otherwise(F.col("kind").isin(*both)))
        .withColumn("fault", F.lit("shape"))
    )
    columns = [*own, "fault", "kind", "n"]
    return absent.select(columns).unionByName(foreign.select(columns)).unionByName(shape.select(columns))


def field_fill(paths: DataFrame, template: Any = None) -> DataFrame:
    """How the template's number fields are filled, over all records: one row per path.

    Columns: ``absent``, ``null_values``, ``numbers``, ``numeric_texts`` (a number in
    quotes), ``others``. One aggregate for all paths; a path that occurs nowhere has zeros.
    """
    wanted = [p for p, kind in template_paths(template) if kind == NUMBER]
    names = {ABSENT: "absent", NULL: "null_values", "number": "numbers", "numeric text": "numeric_texts"}

    def total(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("bigint").alias(name)

    sums = paths.filter(F.col("path").isin(wanted)).groupBy("path").agg(
        *[total(F.col("kind") == kind, name) for kind, name in names.items()],
        total(~F.col("kind").isin(list(names)), "others"),
    )
    every = paths.sparkSession.createDataFrame([(p,) for p in wanted], "path string")
    columns = [*names.values(), "others"]
    return every.join(F.broadcast(sums), "path", "left").select(
        "path", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in columns]
    )


# -- sections ----------------------------------------------------------------------------------
def array_sections(template: dict | None = None) -> dict[str, str]:
    """Sections that hold an array of objects, and the member that numbers an item."""
    found = {}
    for section, value in (TEMPLATE if template is None else template).items():
        if isinstance(value, list) and isinstance(value[0], dict):
            found[section] = POWDER_MEMBER if POWDER_MEMBER in value[0] else SAMPLE_MEMBER
    return found


def member(value: Column, name: str, kind: str = "variant") -> Column:
    """A member of a variant object as ``kind``, or null."""
    return F.try_variant_get(value, f"$['{name}']", kind)


def items_of(record: Column, section: str) -> Column:
    """The items of an array section, or null."""
    return member(record, section, "array<variant>")


def same_sample(number: Column) -> Column:
    """Sample numbers are the same whatever their case and the blanks around them; null if blank."""
    return F.nullif(F.upper(strip(number)), F.lit(""))


def _items(text: Column, template: dict | None) -> Column:
    """All items of all array sections of a record's text, in order; null for a broken record."""
    sections = array_sections(template)
    schema = "struct<" + ",".join(f"`{s}`:array<string>" for s in sections) + ">"

    def of(parsed: Column, section: str, numbered_by: str) -> Column:
        return F.coalesce(
            F.transform(parsed.getField(section), lambda item, i: F.struct(
                F.lit(section).alias("section"), i.alias("position"),
                same_sample(F.from_json(item, f"struct<`{numbered_by}`:string>").getField(numbered_by)).alias("sample_no"),
                item.alias("item"),
            )),
            F.expr("cast(array() as array<struct<section:string,position:int,sample_no:string,item:string>>)"),
        )

    # the parser for structs reads what it can of a broken text, the one for variants refuses it
    whole = F.when(strict_variant(text).isNotNull(), F.from_json(text, schema))
    return let(whole, lambda p: F.concat(*[of(p, s, m) for s, m in sections.items()]))


def section_items(records: DataFrame, text: str = "record_json", template: dict | None = None) -> DataFrame:
    """One row per item of an array section: the other columns, ``section, position, sample_no, item``.

    All sections are unfolded by one generator, so a record is read and parsed once.
    ``sample_no`` is the item's number as :func:`same_sample` sees it, null without one;
    ``item`` is its JSON with members in their order, of any type. A section that is absent, null or no array has no
    items (:func:`path_faults` reports it), and neither has a broken record.
    """
    keep = [c for c in records.columns if c != text]
    rows = records.select(*keep, F.explode(_items(F.col(text), template)).alias("_i"))
    return rows.select(*keep, *[F.col(f"_i.{c}").alias(c) for c in ("section", "position", "sample_no", "item")])


def orphan_samples(records: DataFrame, text: str = "record_json", template: dict | None = None) -> DataFrame:
    """Sample numbers of property sections that the spray section lacks.

    The other columns, ``section``, ``sample_no`` (null: items without a number) and ``n``,
    the items concerned. Decided within the record: no join, no shuffle. A number that the
    spray section repeats, for several layers, counts as there. Powder numbers are not sample numbers.
    """
    keep = [c for c in records.columns if c != text]
    by_sample = [s for s, m in array_sections(template).items() if m == SAMPLE_MEMBER and s != SPRAY_SECTION]

    def lost(items: Column) -> Column:
        sprayed = F.transform(F.filter(items, lambda i: i["section"] == SPRAY_SECTION), lambda i: i["sample_no"])
        others = F.transform(
            F.filter(items, lambda i: i["section"].isin(by_sample)),
            lambda i: F.struct(i["section"].alias("section"), i["sample_no"].alias("sample_no")),
        )
        known = F.filter(sprayed, lambda s: s.isNotNull())
        return let(
            F.array_except(F.transform(others, lambda i: i["sample_no"]), known),
            lambda unknown: F.filter(
                counted(others), lambda c: F.exists(unknown, lambda u: u.eqNullSafe(c["item"]["sample_no"]))
            ),
        )

    found = let(_items(F.col(text), template), lost)
    return records.select(*keep, F.explode(found).alias("_o")).select(
        *keep, F.col("_o.item.section").alias("section"), F.col("_o.item.sample_no").alias("sample_no"),
        F.col("_o.n").alias("n"),
    )


# -- techniques ------------------------------------------------------------------------------------
def _rules(techniques: dict) -> Column:
    """Map from a technique to its needed parameters (arrays of spellings) and all names it allows."""
    return F.create_map(*[
        c for name, (core, other) in techniques.items() for c in (
            F.lit(name),
            F.struct(
                F.array(*[F.array(*map(F.lit, p.split("|"))) for p in core]).alias("needed"),
                F.array(*[F.lit(s) for p in (*core, *other) for s in p.split("|")]).alias("allowed"),
            ),
        )
    ])


def _sprayed(records: DataFrame, text: str) -> tuple[list[str], DataFrame]:
    """One row per item of the spray section: ``position``, ``technique``, ``names`` of parameters."""
    keep = [c for c in records.columns if c != text]

    def items(record: Column) -> Column:
        return F.transform(
            items_of(record, SPRAY_SECTION),
            lambda v, i: F.struct(
                i.alias("position"), strip(member(v, TECHNIQUE_MEMBER, "string")).alias("technique"),
                F.map_keys(member(v, PARAMETERS_MEMBER, "map<string,variant>")).alias("names"),
            ),
        )

    rows = records.select(*keep, F.explode(let(strict_variant(text), items)).alias("_s"))
    return keep, rows.select(*keep, "_s.position", "_s.technique", "_s.names")


def process_param_check(
    records: DataFrame, text: str = "record_json", techniques: dict = TECHNIQUES
) -> DataFrame:
    """Parameters that an item of the spray section lacks, or that belong to other techniques.

    The other columns, ``position``, ``technique``, ``fault`` (missing or foreign) and
    ``parameter``; a missing one of several spellings is named by the first. A parameter
    counts as there even if it is null. An item whose parameters are absent or no object
    lacks all of them. Items of unknown techniques are left to :func:`technique_check`.
    """
    keep, items = _sprayed(records, text)

    def faults(rule: Column) -> Column:
        names = F.coalesce("names", F.expr("cast(array() as array<string>)"))

        def told(found: Column, fault: str) -> Column:
            return F.transform(found, lambda p: F.struct(F.lit(fault).alias("fault"), p.alias("parameter")))

        missing = F.transform(F.filter(rule["needed"], lambda s: ~F.arrays_overlap(s, names)), lambda s: F.get(s, 0))
        return F.concat(told(missing, "missing"), told(F.array_except(names, rule["allowed"]), "foreign"))

    rule = F.element_at(_rules(techniques), F.col("technique"))
    return items.select(*keep, "position", "technique", F.explode(let(rule, faults)).alias("_f")).select(
        *keep, "position", "technique", "_f.fault", "_f.parameter"
    )


def technique_check(records: DataFrame, text: str = "record_json", techniques: dict = TECHNIQUES) -> DataFrame:
    """Items of the spray section whose technique is not in the list; ``technique`` null: none given."""
    keep, items = _sprayed(records, text)
    known = F.coalesce(F.col("technique").isin(list(techniques)), F.lit(False))
    return items.filter(~known).select(*keep, "position", "technique")
