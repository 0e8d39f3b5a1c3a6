"""Task registries: definitions found in source files, merge, diff."""

from __future__ import annotations

import ast
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasklens import constants as K
from tasklens.functions.names import present
from tasklens.functions.text import short_signature

FIELDS = ("module", "engine", "queue", "signature", "declared_in", "loaded", "tags")


def runtime_registry(registry: DataFrame) -> DataFrame:
    """The loaded definitions, without the queue's own; entries without a name are skipped."""
    return registry.filter(~F.col("name").startswith(K.INTERNAL_TASK_PREFIX)).withColumn("loaded", F.lit(True))


def default_queue(own: Column, option: Column) -> Column:
    return F.coalesce(present(own), present(option))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def directory(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*$", "")


# What a partition of files may hold; a file counts as its length and what goes with it.
_PARTITION_BYTES = 32 * 1024 * 1024
_ROW_BYTES = 512


def candidate_files(files: DataFrame, roots: DataFrame, listing: DataFrame | None = None) -> DataFrame:
    """The files of ``files(path, length, ...)`` that may declare tasks under a root of ``roots(root)``.

    The paths are chosen by themselves, from ``listing(path, length)`` where reading ``files`` is dear. What else a file has,
    such as its content, is moved once, by path, into as many partitions as the lengths ask for, and sorted there alone.
    Both joins are sorted ones: roots and paths grow with the files, and what Spark estimates them at, from the bytes of
    compressed columns that they are computed from, says nothing of whether they fit the driver.
    """
    name, folder = file_name(F.col("path")), directory(F.col("path"))
    visible = (name == "__init__.py") | ~name.startswith("_")
    named_so = name.isin(*K.SOURCE_FILE_NAMES)
    in_package = name.endswith(".py") & visible & (file_name(folder) == K.SOURCE_PACKAGE)
    owners = F.array_compact(F.array(F.when(named_so, folder), F.when(in_package, directory(folder))))

    def possible(rows: DataFrame) -> DataFrame:
        return rows.filter((F.col("length") <= K.SOURCE_FILE_BYTES) & (named_so | in_package))

    named = roots.select(F.regexp_replace("root", "/+$", "").alias("_root")).distinct()
    listed = possible(files if listing is None else listing)
    size = listed.agg(F.sum(F.col("length") + _ROW_BYTES)).first()[0] or 0
    chosen = (
        listed.select(F.col("path").alias("_path"), F.explode(owners).alias("_owner"))
        .join(named.hint("merge"), F.col("_owner") == F.col("_root"), "left_semi")
        .select("_path")
    )
    least = files.sparkSession.sparkContext.defaultParallelism * 2
    return (
        possible(files)
        .repartition(max(least, math.ceil(size / _PARTITION_BYTES)), "path")
        .join(chosen.hint("merge"), F.col("path") == F.col("_path"), "left_semi")
        .dropDuplicates(["path"])
    )


def _last_segment(decorator: ast.expr) -> str | None:
    while isinstance(decorator, ast.Call):
        decorator = decorator.func
    return getattr(decorator, "attr", None) or getattr(decorator, "id", None)


def _declared_queue(decorators: list[ast.expr]) -> str | None:
    named = (k.value for d in decorators if isinstance(d, ast.Call) for k in d.keywords if k.arg == "queue")
    texts = (v.value for v in named if isinstance(v, ast.Constant) and isinstance(v.value, str))
    return next(texts, None)


def _signature(spec: ast.arguments) -> str:
    def shown(arg: ast.arg) -> str:
        try:
            return f"{arg.arg}: {ast.unparse(arg.annotation)}" if arg.annotation else arg.arg
        except (RecursionError, ValueError):
            return arg.arg

    shape = [shown(a) for a in [*spec.posonlyargs, *spec.args]]
    shape += [f"*{spec.vararg.arg}"] if spec.vararg else []
    shape += [shown(a) for a in spec.kwonlyargs]
    shape += [f"**{spec.kwarg.arg}"] if spec.kwarg else []
    return f"({', '.join(shape)})"


def _definitions(content: bytes) -> list[tuple[str, str | None, str]]:
    try:
        tree = ast.parse(content.decode("utf-8"))
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return []
    return [
        (node.name, _declared_queue(node.decorator_list), _signature(node.args))
        for node in ast.walk(tree)
        if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef))
        and any(_last_segment(d) in K.TASK_DECORATORS for d in node.decorator_list)
    ]


def scan_definitions(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """The task functions declared in ``files(path, content)``; a file that does not parse declares none.

    Parsing costs far more than moving a file, so ``tasks`` spreads files that lie in few partitions over more.
    """
    if tasks is not None:
        files = files.repartition(tasks, "path")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (path, *definition, position)
                for path, content in zip(batch["path"], batch["content"], strict=True)
                for position, definition in enumerate(_definitions(bytes(content)))
            ]
            yield pd.DataFrame(rows, columns=["path", "function", "queue", "signature", "position"])

    found = files.select("path", "content").mapInPandas(
        scan, "path string, function string, queue string, signature string, position int"
    )
    return found.withColumn("signature", short_signature(F.col("signature")))


def module_names(files: DataFrame, listing: DataFrame) -> DataFrame:
    """Add ``module``: the dotted name that the package folders above a file give it, NULL without any.

    Works on the distinct folders of ``files``: each is opened into its ancestors, which are looked up among the
    folders of ``listing(path)`` that hold an ``__init__.py``; the first one missing ends the package.
    """
    name, folder = file_name(F.col("path")), directory(F.col("path"))
    packages = (
        listing.filter(file_name(F.col("path")) == "__init__.py")
        .select(directory(F.col("path")).alias("_package"))
        .distinct()
    )
    folders = files.select(folder.alias("_folder")).distinct()
    parts = F.split("_folder", "/")
    ancestors = folders.select(
        "_folder", F.posexplode(F.sequence(F.size(parts), F.lit(1), F.lit(-1))).alias("_up", "_size")
    ).withColumn("_ancestor", F.array_join(F.slice(parts, F.lit(1), F.col("_size")), "/"))
    missing = ancestors.join(packages, F.col("_ancestor") == F.col("_package"), "left_anti")
    first_missing = missing.groupBy("_folder").agg(F.min("_up").alias("_depth"))
    depth = F.coalesce("_depth", F.size(parts))
    last = F.greatest(depth, F.lit(1))
    prefix = folders.join(first_missing, "_folder", "left").select(
        F.col("_folder").alias("_of"), F.slice(parts, -last, last).alias("_names"), depth.alias("_depth")
    )
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
    dotted = F.when(F.col("_depth") > 0, F.array_join(F.concat("_names", F.array(stem)), "."))
    return (
        files.join(prefix, folder.eqNullSafe(F.col("_of")), "left")
        .withColumn("module", dotted)
        .drop("_of", "_names", "_depth")
    )


def declared_registry(files: DataFrame, listing: DataFrame) -> DataFrame:
    """Scanned definitions as registry rows, named by module and function.

    ``file_order`` and ``seq`` give their order: by file, then by place in it.
    """
    located = module_names(scan_definitions(files), listing)
    return located.select(
        F.concat_ws(".", "module", "function").alias("name"),
        "module",
        F.lit(K.ENGINE).alias("engine"),
        "queue",
        "signature",
        F.col("path").alias("declared_in"),
        F.lit(False).alias("loaded"),
        F.array().cast("array<string>").alias("tags"),
        F.col("path").alias("file_order"),
        F.col("position").cast("bigint").alias("seq"),
    )


def merge_registry(*sources: DataFrame) -> DataFrame:
    """One definition per name, sorted: loaded beats declared, then the later entry wins.

    Later is the higher ``seq``; rows of scanned files are ordered by ``root_order`` and ``file_order`` first, where there
    are such columns, which the result leaves out.
    The winner is an aggregate, so copies of a name are combined before they are shuffled.
    """
    rows = sources[0]
    for other in sources[1:]:
        rows = rows.unionByName(other, allowMissingColumns=True)
    places = [c for c in ("root_order", "file_order") if c in rows.columns]
    kept = [c for c in rows.columns if c not in ("name", *places)]
    winner = F.max_by(F.struct(*kept), F.struct("loaded", *places, "seq")).alias("_winner")
    return rows.groupBy("name").agg(winner).select("name", "_winner.*").orderBy("name")


def registry_diff(old: DataFrame, new: DataFrame, fields: tuple[str, ...] | None = None) -> DataFrame:
    """What changed between two snapshots, one row per name: ``added``, ``removed`` or ``updated``."""
    if fields is None:
        fields = tuple(c for c in FIELDS if c in old.columns and c in new.columns)
    before = old.select(F.col("name").alias("_old"), *[F.col(c).alias(f"_old_{c}") for c in fields])
    after = new.select("name", *fields)
    same = F.lit(True)
    for c in fields:
        same = same & F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    change = (
        F.when(F.col("_old").isNull(), "added").when(F.col("name").isNull(), "removed").when(~same, "updated")
    )
    return (
        after.join(before, F.col("name") == F.col("_old"), "full_outer")
        .select(F.coalesce("name", "_old").alias("name"), change.alias("change"), *fields)
        .filter("change is not null")
    )
