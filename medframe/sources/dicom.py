"""Read DICOM files as a DataFrame: one row per file, one column per keyword.

Plan of a scan (no shuffle anywhere)::

    binaryFile (driver lists files; executors load bytes; length /
                modificationTime / partition filters pushed into the listing)
      -> mapInArrow(kernel)        one Arrow batch of files at a time
      -> selectExpr(decoders)      whole-stage codegen, pruned by Catalyst

``columns=`` narrows what the kernel keeps (Catalyst cannot prune through an
Arrow batch function), ``where=`` filters on file columns before any byte is
parsed, and PixelData is skipped unless asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, MapType, StringType, StructField, StructType

from medframe import dictionary as dictmod
from medframe import ship
from medframe.functions import decode
from medframe.functions.values import NO_NAME, raw_kind
from medframe.sources.files import conf_of, supported
from medframe.sources.kernel import Column, Spec, column_name, kernel_schema_ddl, make_kernel
from medframe.sources.predicates import predicate

PATH, ISDICOM, KEYWORDS, VRS, ERRORS = "path", "isDicom", "keywords", "vrs", "errors"
CONTENT, PRIVATE = "content", "privateTagsJson"
METADATA_COLUMNS = (PATH, ISDICOM, KEYWORDS, VRS, ERRORS)
_BINARY_FILE_COLUMNS = {"path", "modificationTime", "length", "content"}
NUMERIC_VRS = frozenset("FL FD SL SS US UL SV UV".split())

OPTION_INCLUDE_PIXEL_DATA = "includePixelData"
OPTION_INCLUDE_CONTENT = "includeContent"
OPTION_INCLUDE_PRIVATE_TAGS = "includePrivateTags"


def bool_option(options: dict | None, key: str) -> bool:
    """Case-insensitive boolean option; anything unparsable counts as false."""
    if not options:
        return False
    for k, v in options.items():
        if k.lower() == key.lower():
            if isinstance(v, bool):
                return v
            return str(v).strip().lower() == "true"
    return False


def schema_ddl(
    include_pixel_data: bool = False,
    include_content: bool = False,
    include_private_tags: bool = False,
    dictionary: dictmod.Dictionary | None = None,
) -> str:
    """DDL of the full scan schema: metadata, dictionary columns, options."""
    d = dictionary or dictmod.active()
    cols = [
        "path string not null",
        "isDicom boolean not null",
        "keywords array<string>",
        "vrs map<string,string>",
        "errors map<string,string> not null",
    ]
    for e in d.column_elements(include_pixel_data):
        cols.append(f"{decode.quote_ident(e.keyword)} {decode.spark_type(e.single_vr)}")
    if include_content:
        cols.append("content binary")
    if include_private_tags:
        cols.append("privateTagsJson string")
    return ", ".join(cols)


def schema(
    include_pixel_data: bool = False,
    include_content: bool = False,
    include_private_tags: bool = False,
    dictionary: dictmod.Dictionary | None = None,
) -> StructType:
    """The scan schema as a ``StructType`` (S16), for streams and user schemas."""
    d = dictionary or dictmod.active()
    text = StringType()
    out = [StructField(PATH, text, False), StructField(ISDICOM, BooleanType(), False),
           StructField(KEYWORDS, ArrayType(text)), StructField(VRS, MapType(text, text)),
           StructField(ERRORS, MapType(text, text), False)]
    out += [StructField(e.keyword, decode.data_type(e.single_vr)) for e in d.column_elements(include_pixel_data)]
    if include_content:
        out.append(StructField(CONTENT, BinaryType()))
    if include_private_tags:
        out.append(StructField(PRIVATE, text))
    return StructType(out)


def _resolve_columns(columns, d, include_pixel_data, include_content, include_private, passed=()):
    """Requested keyword columns in order; raises on an unknown name. ``passed``:
    other columns of the files (partition columns), which may be named too."""
    extra = {CONTENT: include_content, PRIVATE: include_private}
    allowed = {e.keyword: e for e in d.column_elements(include_pixel_data)}
    if columns is None:
        return list(allowed.values()), [c for c, on in extra.items() if on]
    keywords, extras = [], []
    for c in columns:
        if c in METADATA_COLUMNS or c in passed:
            continue
        if c in extra:
            if not extra[c]:
                raise ValueError(f"column {c!r} needs the option that includes it")
            extras.append(c)
        elif c in allowed:
            keywords.append(allowed[c])
        else:
            raise ValueError(f"Unsupported field name: {c!r} is not a DICOM keyword column")
    return keywords, extras


def _resolve_filters(predicates, d, include_pixel_data) -> list:
    """The elements that filters name; raises on columns that hold no text."""
    allowed = {e.keyword: e for e in d.column_elements(include_pixel_data)}
    out = []
    for p in predicates:
        e = allowed.get(p.column[0])
        if e is None and (p.column[0] not in (PATH, ISDICOM) or len(p.column) > 1):
            raise ValueError(f"cannot filter on {'.'.join(p.column)!r}: it is not a DICOM keyword column")
        if e is not None:
            if not filterable(e.single_vr, p.column):
                raise ValueError(f"cannot filter on {'.'.join(p.column)!r}: its values are not text")
            if e not in out:
                out.append(e)
    return out


def filterable(vr: str, column: tuple) -> bool:
    """Whether a predicate can judge ``column`` of this VR."""
    if vr == "PN":
        return len(column) == 2 and column[1] in NO_NAME
    return len(column) == 1 and raw_kind(vr) == "str"


def decode_frame(
    files: DataFrame,
    columns: list[str] | None = None,
    include_pixel_data: bool = False,
    include_content: bool = False,
    include_private_tags: bool = False,
    dictionary: dictmod.Dictionary | None = None,
    keep_elements: bool = False,
    header_only: bool = False,
    filters: list[tuple] | None = None,
    options: dict | None = None,
) -> DataFrame:
    """Tokenise and decode a DataFrame of ``path, content`` (+ other columns,
    passed through). This is the scan body; ``read`` feeds it from files.

    ``keep_elements`` adds ``elements``: keyword -> raw slot
    ``struct<vr, str, ints, dbls, bin>`` with all values (``str`` keeps every
    backslash-separated value), for queries beyond the first value.

    ``header_only``: ``files`` has ``path`` (and ``length``) but no
    ``content``; each executor opens its files and reads them only up to
    PixelData, so pixel bytes never leave storage. ``options``: how to reach
    their file systems (see ``medframe.sources.files``).

    ``filters``: (column, op, value[, negated]) that all must hold, as ``where``
    after the scan would decide it, but judged while a file is read: the first
    element that fails ends its reading. Columns: path, isDicom, keywords with
    text, or (person name, group); ops: see ``medframe.sources.predicates``."""
    ship.ensure(files.sparkSession)
    d = dictionary or dictmod.active()
    passthrough = [c for c in files.columns if c not in _BINARY_FILE_COLUMNS]
    elems, extras = _resolve_columns(
        columns, d, include_pixel_data, include_content, include_private_tags, passthrough
    )
    if header_only and include_content:
        raise ValueError("includeContent needs the file bytes; not available with header_only")
    fields = {f.name: f for f in files.schema.fields}
    pass_ddl = [f"{decode.quote_ident(c)} {fields[c].dataType.simpleString()}" for c in passthrough]
    stop_at_pixel = not (include_pixel_data and any(e.keyword == "PixelData" for e in elems))
    if header_only and not stop_at_pixel:
        # whole pixel arrays would pile up in one output batch; binaryFile's
        # byte-capped batches bound that in the content mode
        raise ValueError("PixelData needs whole files; read it with header_only=False")
    predicates = tuple(predicate(*f) for f in filters or ())
    read_too = [e for e in _resolve_filters(predicates, d, include_pixel_data) if e not in elems]
    spec = Spec(
        tags={e.tag: (e.keyword, e.vr) for e in d.elements},
        columns=[Column(e.keyword, e.tag, e.vr, e.single_vr) for e in [*elems, *read_too]],
        stop_at_pixel=stop_at_pixel,
        private=include_private_tags,
        content=include_content,
        want_vrs=columns is None or KEYWORDS in columns or VRS in columns,
        elements=keep_elements,
        predicates=predicates,
        conf=conf_of(options),
        passthrough=tuple(passthrough),
    )
    source_cols = ["path", "length"] if header_only else ["path", "content"]
    if header_only and "length" not in files.columns:
        source_cols = ["path"]
    tokens = files.select(*source_cols, *passthrough).mapInArrow(make_kernel(spec), kernel_schema_ddl(spec, pass_ddl))
    names = {e.keyword: column_name(i) for i, e in enumerate(elems)}
    parsed = decode.parsed_arrays([(e.keyword, e.single_vr) for e in elems], names)
    if parsed.arrays:
        tokens = tokens.selectExpr("*", *parsed.arrays)
    exprs = [
        "path",
        "isDicom",
        "if(isDicom, map_keys(vrs), null) as keywords",
        "vrs",
    ]
    exprs.append(f"map_concat(if(isDicom, kerrors, cast(map() as map<string,string>)), {parsed.errors}) as errors")
    for e in elems:
        ok = "isDicom"
        if e.single_vr in NUMERIC_VRS:  # a value that failed to convert -> null
            ok = f"isDicom and not map_contains_key(kerrors, {decode.sql_str(e.keyword)})"
        dec = parsed.values.get(e.keyword) or decode.value_sql(e.single_vr, names[e.keyword], ok=ok)
        exprs.append(f"{dec} as {decode.quote_ident(e.keyword)}")
    for c in extras:
        exprs.append(c)
    for c in passthrough:
        exprs.append(decode.quote_ident(c))
    if keep_elements:
        exprs.append("if(isDicom, attrs, null) as elements")
    out = tokens.selectExpr(*exprs)
    if columns is not None:
        order = [c for c in columns] + [c for c in passthrough if c not in columns]
        if keep_elements:
            order.append("elements")
        out = out.select(*[decode.quote_ident(c) for c in order])
    return out


# Header-only tasks read a few KiB per file, but file splits are sized by whole
# file bytes; merging up to this many splits per task cuts per-task overhead.
HEADER_SPLITS_PER_TASK = 8


def _fewer_tasks(files: DataFrame) -> DataFrame:
    """Coalesce (no shuffle) the splits of a header-only scan, keeping at
    least two tasks per core. ``files`` is a bare listing, so counting its splits
    plans it and runs no job."""
    n = files.rdd.getNumPartitions()
    floor = 2 * files.sparkSession.sparkContext.defaultParallelism
    target = max(floor, n // HEADER_SPLITS_PER_TASK)
    return files.coalesce(target) if target < n else files


def file_system_options(spark: SparkSession, options: dict | None) -> dict:
    """How to reach file systems: the session's Hadoop settings for them (what
    ``binaryFile`` itself would use), then the reader's options."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    conf = {start + rest: value for start in SHARED_SETTINGS
            for rest, value in dict(hadoop.getPropsWithPrefix(start)).items()}
    return conf | dict(conf_of(options))


# Settings of a session that executors need to open files themselves.
SHARED_SETTINGS = ("fs.s3a.access.key", "fs.s3a.secret.key", "fs.s3a.session.token", "fs.s3a.endpoint",
                   "fs.s3a.bucket.", "fs.s3a.aws.credentials.provider", "fs.s3a.path.style.access",
                   "fs.s3a.connection.ssl.enabled", "fs.gs.auth.type", "fs.azure.account.key.",
                   "fs.azure.sas.fixed.token.")


def _openable(spark: SparkSession, path: str, conf: dict) -> bool:
    """Whether executors can open ``path`` by ranges (a path without a scheme
    belongs to the default file system)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    scheme = p.toUri().getScheme()
    if scheme is None:
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        scheme = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(hadoop).getScheme()
    return supported(f"{scheme}://", conf)


def binary_files(
    spark: SparkSession,
    path: str | list[str],
    where: str | None = None,
    options: dict | None = None,
) -> DataFrame:
    """The ``binaryFile`` listing; ``where`` may use path, length,
    modificationTime and partition columns and is applied before reading."""
    reader = spark.read.format("binaryFile")
    for k, v in (options or {}).items():
        if k.lower() not in (
            OPTION_INCLUDE_PIXEL_DATA.lower(),
            OPTION_INCLUDE_CONTENT.lower(),
            OPTION_INCLUDE_PRIVATE_TAGS.lower(),
            "headeronly",
        ):
            reader = reader.option(k, v)
    df = reader.load(path)
    if where:
        df = df.where(where)
    return df


def read(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str] | None = None,
    include_pixel_data: bool | None = None,
    include_content: bool | None = None,
    include_private_tags: bool | None = None,
    where: str | None = None,
    options: dict | None = None,
    schema: StructType | None = None,
    dictionary: dictmod.Dictionary | None = None,
    header_only: bool | None = None,
    filters: list[tuple] | None = None,
) -> DataFrame:
    """Read DICOM files (path, directory or glob) as a DataFrame.

    ``header_only`` (option ``headerOnly``): list files with ``binaryFile``
    but do not load their bytes in the JVM; executors read each file by ranges,
    only up to PixelData, through ``pyarrow.fs`` with the credentials of the
    session and of the options. By default it is on unless content or pixel data
    is requested, or the scheme has no file system there
    (``medframe.sources.files``): then whole files are loaded by ``binaryFile``.
    ``filters``: see ``decode_frame``.

    Options as in ``spark.read.option``: ``includePixelData``,
    ``includeContent``, ``includePrivateTags`` (case-insensitive booleans), and
    any ``binaryFile`` / file-system option (``pathGlobFilter``,
    ``recursiveFileLookup``, credentials ...), passed through.
    A user ``schema`` restricts the columns to its field names.
    """
    opts = dict(options or {})
    pix = bool_option(opts, OPTION_INCLUDE_PIXEL_DATA) if include_pixel_data is None else include_pixel_data
    con = bool_option(opts, OPTION_INCLUDE_CONTENT) if include_content is None else include_content
    prv = bool_option(opts, OPTION_INCLUDE_PRIVATE_TAGS) if include_private_tags is None else include_private_tags
    if schema is not None:
        columns = [f.name for f in schema.fields]
        pix = pix or "PixelData" in columns
        con = con or CONTENT in columns
        prv = prv or PRIVATE in columns
    if header_only is None and any(k.lower() == "headeronly" for k in opts):
        header_only = bool_option(opts, "headerOnly")
    conf = file_system_options(spark, opts)
    if header_only is None:
        paths = [path] if isinstance(path, str) else list(path)
        header_only = not con and not pix and all(_openable(spark, p, conf) for p in paths)
    files = binary_files(spark, path, where, opts)
    if header_only:
        files = _fewer_tasks(files.drop("content"))
    return decode_frame(files, columns, pix, con, prv, dictionary, header_only=header_only, filters=filters, options=conf)


def elements_long(scanned: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per (file, element) of a scan made with ``keep_elements=True``:
    ``keep`` columns (default ``path``), ``keyword``, ``vr`` and ``value`` —
    every value as DICOM text (backslash-separated), bytes as hex, sequences
    as JSON. A generator over the element map: no shuffle; its output feeds
    ``deid.deidentify_long``."""
    keep = keep or ["path"]
    e = "e"
    # unsigned values are kept in signed slots
    unsigned = (f"if(x < 0 and {e}.vr in ('UL', 'UV'), cast(x as decimal(20, 0)) + "
                f"if({e}.vr = 'UL', 4294967296BD, 18446744073709551616BD), cast(x as decimal(20, 0)))")
    value = (
        f"coalesce({e}.str, "
        f"array_join(transform({e}.ints, x -> cast({unsigned} as string)), '\\\\'), "
        f"array_join(transform({e}.dbls, x -> cast(x as string)), '\\\\'), "
        f"hex({e}.bin))"
    )
    exploded = scanned.selectExpr(*[decode.quote_ident(c) for c in keep],
                                  "explode(elements) as (keyword, e)")
    return exploded.selectExpr(*[decode.quote_ident(c) for c in keep], "keyword", "e.vr as vr",
                               f"{value} as value")
