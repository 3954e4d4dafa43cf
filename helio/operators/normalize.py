"""Raw rows and JSON payloads of several shapes as canonical observation records.

Payload shapes vary from record to record, so they are parsed once into a VARIANT and
read by path. Whether a value counts as absent follows the usual truth rules of JSON
consumers: null, empty text, zero, false and empty containers fall through to the next
candidate field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import coerce_float
from ..schema import MEASURES
from .once import computed_once

# Where each kind of payload keeps its time and its measures.
ROW_TIMES = ("time_tag", "timestamp", "time")
GRID_TIMES = ("Observation Time", "Forecast Time")
FEATURE_SPEEDS = ("mag", "magnitude", "speed")
FEATURE_BTS = ("sig", "score", "bt")
FEATURE_FIELDS = tuple(dict.fromkeys(("depth", *FEATURE_SPEEDS, *FEATURE_BTS, *MEASURES)))
ZERO_TEXT = r"^-?0+(\.0*)?([eE].*)?$"


# --- flat rows -----------------------------------------------------------------------


def _text_truthy(value: Column) -> Column:
    return F.when(value != "", value)


def normalize_rows(df: DataFrame, arrival: str | None = None) -> DataFrame:
    """Flat rows (as read from CSV) in canonical form: eight columns, no missing number.

    The time is the first non-empty of ``time_tag`` and ``timestamp``, else ``time``,
    else the text of the ``arrival`` column.
    """

    def field(name: str) -> Column:
        return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")

    *first, last = [field(name) for name in ROW_TIMES]
    fallback = [F.col(arrival).cast("string")] if arrival else []
    time_tag = F.coalesce(*[_text_truthy(c) for c in first], last, *fallback)
    return df.select(
        time_tag.alias("time_tag"), *[coerce_float(field(m)).alias(m) for m in MEASURES]
    )


# --- JSON values ---------------------------------------------------------------------


def _at(value: Column, *names: str) -> Column:
    path = "$" + "".join(f"['{name}']" for name in names)
    return F.try_variant_get(value, path, "variant")


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _texts(value: Column, names: tuple[str, ...]) -> Column:
    """Several fields of a JSON object as texts, read in one go; null for other values."""
    fields = ", ".join(f"`{name}`: string" for name in names)
    return F.try_variant_get(value, "$", f"struct<{fields}>")


def _items(value: Column) -> Column:
    """The elements of a JSON array, null for any other value."""
    return F.try_variant_get(value, "$", "array<variant>")


def _is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _number(text: Column, value: Column) -> Column:
    """A JSON value, given as text and as parsed, as a double.

    Booleans count 1 and 0, texts are parsed, anything else gives 0.
    """
    is_true = (text == "true") & (_kind(value) == "BOOLEAN")
    return F.when(is_true, 1.0).otherwise(coerce_float(text))


def _truthy(text: Column, value: Column) -> Column:
    """The text of a JSON value unless it is null, empty, zero or false.

    The kind is looked up only for the few texts it matters for.
    """
    zero = (text == "false") | ((text.startswith("0") | text.startswith("-")) & text.rlike(ZERO_TEXT))
    falsy = text.isin("", "[]", "{}") | (zero & (_kind(value) != "STRING"))
    return F.when(~falsy, text)


# --- payload shapes ------------------------------------------------------------------


def _units(df: DataFrame, payload: str, arrival: str | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parsed payloads with the list of what they hold: one grid, or some events."""
    now = F.col(arrival).cast("string") if arrival else F.lit(None).cast("string")
    root = F.col("root")
    events = F.coalesce(
        _items(_at(root, "features")),
        _items(_at(root, "results")),
        F.when(_is_object(root), F.array(root)),
        _items(root),
    )
    texts = df.select(*keep, F.col(payload).alias("payload"), now.alias("now"))
    parsed = computed_once(texts, "root", F.try_parse_json("payload")).withColumn(
        "is_grid", _items(_at(root, "coordinates")).isNotNull()
    )
    return parsed.withColumn(
        "units", F.when(F.col("is_grid"), F.array(root)).otherwise(events)
    ).withColumn("grid", F.when(F.col("is_grid"), _grid_measures(root)))


def _grid_measures(grid: Column) -> Column:
    """Statistics of the intensities of ``[lon, lat, intensity]`` cells, as a record."""

    def intensity(cell: Column) -> Column:
        parts = _items(cell)
        value = F.when(F.size(parts) >= 3, F.get(parts, 2)).otherwise(F.get(parts, 0))
        return _number(_text(value), value)

    cells = _items(_at(grid, "coordinates"))
    found = F.transform(F.filter(cells, lambda cell: _items(cell).isNotNull()), intensity)
    values = F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(0.0)))

    def figures(v: Column) -> Column:
        mean = F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / F.size(v)
        highest = F.array_max(v)
        measures = {
            "speed": mean,
            "density": F.size(F.filter(v, lambda x: x > 0)).cast("double"),
            "temperature": highest,
            "bx": mean,
            "by": F.size(cells).cast("double"),
            "bz": F.lit(0.0),
            "bt": highest,
        }
        return F.struct(*[measures[name].alias(name) for name in MEASURES])

    # one-element transform, so that the list is built once for all figures
    return F.get(F.transform(F.array(values), figures), 0)


def _read_units(units: DataFrame) -> DataFrame:
    """Canonical records; a step for each depth of reading keeps the generated code small."""
    unit, props, body, is_grid = (F.col(c) for c in ("unit", "props", "body", "is_grid"))
    # a plain explode would have the optimizer parse every payload again, in a filter
    # it infers for empty lists
    exploded = units.select("now", "is_grid", "grid", F.explode_outer("units").alias("unit"))
    objects = exploded.select(
        "*",
        _texts(unit, (*ROW_TIMES, *GRID_TIMES)).alias("outer"),
        F.when(~is_grid & _is_object(_at(unit, "properties")), _at(unit, "properties")).alias(
            "props"
        ),
    ).where(F.col("outer").isNotNull())
    point = _items(_at(unit, "geometry", "coordinates"))
    read = objects.select(
        "*",
        F.coalesce(props, unit).alias("body"),
        _texts(F.coalesce(props, unit), ("time", *FEATURE_FIELDS)).alias("inner"),
        F.when(props.isNotNull() & (F.size(point) >= 3), F.get(point, 2)).alias("third"),
    )

    def outer(name: str) -> Column:
        return _truthy(F.col("outer")[name], _at(unit, name))

    def inner(name: str) -> Column:
        return _truthy(F.col("inner")[name], _at(body, name))

    def number(name: str) -> Column:
        return _number(F.col("inner")[name], _at(body, name))

    def first(*names: str) -> Column:
        *earlier, last = names
        taken = [F.when(props.isNotNull() & inner(n).isNotNull(), number(n)) for n in earlier]
        return F.coalesce(*taken, number(last))

    depth = F.when(F.col("third").isNotNull(), _number(_text(F.col("third")), F.col("third")))
    measures = {name: number(name) for name in MEASURES}
    measures["speed"] = first(*FEATURE_SPEEDS)
    measures["density"] = F.coalesce(
        depth, F.when(props.isNotNull(), number("depth")).otherwise(number("density"))
    )
    measures["bt"] = first(*FEATURE_BTS)
    flat_time, later_times = ROW_TIMES[0], ROW_TIMES[1:]
    event_times = [
        F.when(props.isNotNull(), inner("time")).otherwise(outer(flat_time)),
        *[outer(name) for name in later_times],
        # a flat row keeps even an empty last time
        F.when(props.isNull(), F.col("outer")[later_times[-1]]),
    ]
    time_tag = F.coalesce(
        F.when(is_grid, F.coalesce(*[outer(name) for name in GRID_TIMES])).otherwise(
            F.coalesce(*event_times)
        ),
        F.col("now"),
    )
    return read.select(
        time_tag.alias("time_tag"),
        *[F.coalesce(F.col("grid")[m], measures[m]).alias(m) for m in MEASURES],
    )


def normalize_grid(df: DataFrame, payload: str = "payload", arrival: str | None = None) -> DataFrame:
    """Canonical records of the grid payloads in ``df``, one each."""
    return _read_units(_units(df, payload, arrival).where(F.col("is_grid")))


def normalize_events(
    df: DataFrame, payload: str = "payload", arrival: str | None = None
) -> DataFrame:
    """Canonical records of the event payloads in ``df``: envelopes, lists, single objects."""
    return _read_units(_units(df, payload, arrival).where(~F.col("is_grid")))


def normalize_payloads(
    df: DataFrame, payload: str = "payload", arrival: str | None = None
) -> DataFrame:
    """Canonical records of every readable payload, whatever its shape, in one pass."""
    return _read_units(_units(df, payload, arrival))


def rejected_payloads(df: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Payloads that are no JSON object or array, or that list something else than objects, with the columns ``keep``."""
    unread = F.col("units").isNull() | F.exists("units", lambda unit: ~_is_object(unit))
    return _units(df, payload, None, keep).where(unread).select(*keep, "payload")
