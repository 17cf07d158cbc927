"""medframe: DICOM metadata as Spark DataFrames.

Read folders or streams of DICOM files as a table (one row per file, one typed
column per keyword), de-identify by the PS3.15 confidentiality profile, find
and drop deep-empty columns, and turn image frames into rows. Everything is a
DataFrame plan: built-in SQL expressions where possible, Arrow batch functions
for byte-level work, no driver-side loops over data.

Top-level names are loaded lazily (executors import only what they run)::

    import medframe as mf
    df = mf.read(spark, "/data/ct")
    clean = mf.deidentify(df, {mf.DeidOption.CleanDesc: True})
"""

from importlib import import_module

from medframe.dictionary import DeidOption  # noqa: F401

__version__ = "0.1.0"

_EXPORTS = {
    "read": "medframe.sources.dicom",
    "decode_frame": "medframe.sources.dicom",
    "schema": "medframe.sources.dicom",
    "elements_long": "medframe.sources.dicom",
    "read_stream": "medframe.streaming.dicom_stream",
    "deidentify": "medframe.operators.deid",
    "deidentify_long": "medframe.operators.deid",
    "drop_deep_empty": "medframe.operators.profile",
    "filled_counts": "medframe.operators.profile",
    "is_deep_empty": "medframe.operators.profile",
    "frames": "medframe.operators.frames",
    "read_frames": "medframe.operators.frames",
    "to_image": "medframe.operators.frames",
    "install": "medframe.sources.register",
}


def __getattr__(name):
    if name in _EXPORTS:
        return getattr(import_module(_EXPORTS[name]), name)
    raise AttributeError(f"module 'medframe' has no attribute {name!r}")


__all__ = ["DeidOption", *_EXPORTS]
