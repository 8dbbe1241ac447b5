"""Multidimensional JSON cubes (JSON-stat): axes with code positions and a flat map of values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CUBE = """struct<
    value: map<string, double>,
    dimension: map<string, struct<category: struct<index: map<string, int>, label: map<string, string>>>>>"""


def read_cube_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(source, body): one row per response. A dataset is landed as many slices, which is what spreads the work."""
    return (
        spark.read.option("wholetext", "true").text(path)
        .select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("body"))
    )


def _codes_by_position(index: Column) -> Column:
    """Code at each position; 'unknown_<n>' where the index names none.

    As long as twice the number of codes at most, whatever positions the document names: see :func:`_codes_beyond`.
    """
    by_position = _by_position(index)
    last = F.least(F.array_max(F.map_values(index)), 2 * F.size(index))
    return F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda p: F.coalesce(F.try_element_at(by_position, p), F.concat(F.lit("unknown_"), p.cast("string"))))


def _by_position(index: Column) -> Column:
    return F.map_from_entries(
        F.transform(F.map_entries(index), lambda e: F.struct(e["value"].alias("key"), e["key"].alias("value"))))


def _codes_beyond(index: Column) -> Column:
    """Codes at positions far beyond their number: a map, empty for any sound document."""
    return F.map_filter(_by_position(index), lambda p, _: p > 2 * F.size(index))


def _labels_by_position(codes: Column, label: Column) -> Column:
    return F.transform(
        codes, lambda c: F.nullif(F.nullif(F.try_element_at(label, c), c), F.lit("")))


def parse_cubes(files: DataFrame, body: str = "body") -> DataFrame:
    """Add ``cube`` (parsed), ``axes`` (names in document order) and ``problem`` (NULL when usable)."""
    parsed = files.withColumns({
        "cube": F.from_json(F.col(body), CUBE),
        "axes": F.json_object_keys(F.get_json_object(F.col(body), "$.dimension")),
    })
    problem = (
        F.when(F.col("cube").isNull() | F.col("cube.dimension").isNull(), F.lit("missing key: dimension"))
        .when(F.col("cube.value").isNull(), F.lit("missing key: value"))
        .when(F.size("axes") == 0, F.lit("no axes"))
    )
    return parsed.withColumn("problem", problem)


def cube_problems(files: DataFrame, body: str = "body") -> DataFrame:
    """Responses that cannot be decoded, with the reason. The others go on without them."""
    return parse_cubes(files, body).filter(F.col("problem").isNotNull()).drop("cube", "axes", body)


def decode_cubes(files: DataFrame, declared: list[str], body: str = "body", strict: bool = False) -> DataFrame:
    """One row per observation: the identifying columns of ``files``, a code column per declared axis, its label
    where one exists and differs, and ``value``.

    Positions follow from the flat index by row-major strides. Axis tables are prepared once per response; the rows
    exploded from it only index into them.
    """
    ids = [c for c in files.columns if c != body]
    parsed = parse_cubes(files, body)
    if strict:
        parsed = parsed.withColumn("cube", F.when(
            F.col("problem").isNotNull(), F.raise_error(F.concat(F.lit("cube: "), F.col("problem")))
        ).otherwise(F.col("cube")))
    usable = parsed.filter(F.col("problem").isNull())

    lowered = F.transform("axes", lambda a: F.lower(a))
    sizes = F.transform("axes", lambda a: F.size(F.element_at(F.col("cube.dimension"), a)["category"]["index"])
                        .cast("bigint"))
    strides = F.transform(
        F.sequence(F.lit(1), F.size("axes")),
        lambda i: F.aggregate(F.slice(F.col("sizes"), i + 1, F.size("axes")), F.lit(1).cast("bigint"),
                              lambda acc, s: acc * s))
    prepared = usable.withColumns({"names": lowered, "sizes": sizes}).withColumn("strides", strides)
    per_axis: dict[str, Column] = {}
    for name in declared:
        spot = F.array_position("names", name).cast("int") - 1
        category = F.element_at(F.col("cube.dimension"), F.get("axes", spot))["category"]
        per_axis[f"_at_{name}"] = spot
        per_axis[f"_codes_{name}"] = F.when(spot >= 0, _codes_by_position(category["index"]))
        per_axis[f"_beyond_{name}"] = F.when(spot >= 0, _codes_beyond(category["index"]))
        per_axis[f"_stride_{name}"] = F.get("strides", spot)
        per_axis[f"_size_{name}"] = F.get("sizes", spot)
    prepared = prepared.withColumns(per_axis)
    prepared = prepared.withColumns({
        f"_labels_{n}": F.when(F.col(f"_at_{n}") >= 0, _labels_by_position(
            F.col(f"_codes_{n}"),
            F.element_at(F.col("cube.dimension"), F.get("axes", F.col(f"_at_{n}")))["category"]["label"]))
        for n in declared
    })
    carried = [c for n in declared
               for c in (f"_at_{n}", f"_codes_{n}", f"_beyond_{n}", f"_labels_{n}", f"_stride_{n}", f"_size_{n}")]
    exploded = prepared.select(*ids, *carried, F.explode("cube.value").alias("_flat", "value")) \
        .withColumn("_flat", F.col("_flat").cast("bigint"))

    out: list[Column] = [F.col(c) for c in ids]
    for n in declared:
        # the first axis has no modulus: a flat index beyond the cube shows as an unknown position
        whole = F.expr(f"_flat div _stride_{n}")
        spot = F.when(F.col(f"_at_{n}") == 0, whole).otherwise(whole % F.col(f"_size_{n}")).cast("int")
        code = F.coalesce(F.get(f"_codes_{n}", spot), F.try_element_at(f"_beyond_{n}", spot), F.concat(F.lit("unknown_"), spot.cast("string")))
        out += [F.when(F.col(f"_at_{n}") >= 0, code).alias(n), F.get(f"_labels_{n}", spot).alias(f"{n}_label")]
    return exploded.select(*out, "value")


def axes_found(files: DataFrame, body: str = "body") -> list[str]:
    """Lower-case axis names of all responses. Names of dimensions, not codes: a few, whatever the data."""
    names = files.select(F.explode(F.json_object_keys(F.get_json_object(F.col(body), "$.dimension"))).alias("a"))
    return sorted(r["a"] for r in names.select(F.lower("a").alias("a")).distinct().collect())


def decode_any(files: DataFrame, body: str = "body") -> DataFrame:
    """One row per observation of responses with any axes, in one scan: the identifying columns of ``files``,
    ``coordinates`` (axis -> code, in document order), ``labels`` (axis -> label where one exists and differs), ``value``.

    Strides follow the axes in the order of the document, so the order has to come from its text: parsed into a VARIANT,
    an object has its keys in order of the alphabet.
    """
    ids = [c for c in files.columns if c != body]
    usable = parse_cubes(files, body).filter(F.col("problem").isNull())
    category = lambda a: F.element_at(F.col("cube.dimension"), a)["category"]
    axis = F.transform("axes", lambda a: F.struct(
        F.lower(a).alias("name"), F.size(category(a)["index"]).cast("bigint").alias("size"),
        _codes_by_position(category(a)["index"]).alias("codes"), _codes_beyond(category(a)["index"]).alias("beyond"),
        category(a)["label"].alias("label")))
    strided = F.transform("axis", lambda x, i: F.struct(
        F.aggregate(F.slice("axis", i + 2, F.size("axis")), F.lit(1).cast("bigint"), lambda acc, y: acc * y["size"]).alias("stride"), i.alias("at"),
        _labels_by_position(x["codes"], x["label"]).alias("labels")))
    prepared = usable.withColumn("axis", axis).withColumn("plan", strided)
    rows = prepared.select(*ids, "axis", "plan", F.explode("cube.value").alias("_flat", "value")).withColumn("_flat", F.col("_flat").cast("bigint"))

    def spot(x: Column, p: Column) -> Column:
        # the first axis has no modulus: a flat index beyond the cube shows as an unknown position
        whole = F.floor(F.col("_flat") / p["stride"]).cast("bigint")
        return F.when(p["at"] == 0, whole).otherwise(whole % F.greatest(x["size"], F.lit(1))).cast("int")

    def entry(x: Column, p: Column) -> Column:
        at = spot(x, p)
        code = F.coalesce(F.get(x["codes"], at), F.try_element_at(x["beyond"], at), F.concat(F.lit("unknown_"), at.cast("string")))
        return F.struct(x["name"].alias("name"), code.alias("code"), F.get(p["labels"], at).alias("label"))

    placed = rows.withColumn("_place", F.zip_with("axis", "plan", entry))
    return placed.select(
        *ids, F.map_from_entries(F.transform("_place", lambda e: F.struct(e["name"], e["code"]))).alias("coordinates"),
        F.map_from_entries(F.transform(F.filter("_place", lambda e: e["label"].isNotNull()),
                                       lambda e: F.struct(e["name"], e["label"]))).alias("labels"), "value")


def with_axes(rows: DataFrame, axes: list[str]) -> DataFrame:
    """Rows of :func:`decode_any` in the shape of :func:`decode_cubes`: a code and a label column per axis."""
    out = [c for name in axes for c in (F.try_element_at("coordinates", F.lit(name)).alias(name), F.try_element_at("labels", F.lit(name)).alias(f"{name}_label"))]
    return rows.select(*[c for c in rows.columns if c not in ("coordinates", "labels", "value")], *out, "value")
