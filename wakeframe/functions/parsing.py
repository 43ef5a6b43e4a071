"""Labels, frame names and frame sampling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_code(label: Column, positive: str = "drowsy") -> Column:
    return F.when(label == positive, 1).otherwise(0)


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def file_stem(name: Column) -> Column:
    """The name without its last suffix; a leading dot is no suffix."""
    return F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")


def frame_number(name: Column, suffix: str = r"\.jpg") -> Column:
    """The digits of ``_f<digits>.jpg`` at the end, else 0."""
    digits = F.regexp_extract(name, rf"_f(\d+){suffix}$", 1)
    return F.coalesce(F.nullif(digits, F.lit("")).try_cast("long"), F.lit(0).cast("long"))


def drop_first(text: Column, part: Column) -> Column:
    """Remove the first occurrence of ``part``, wherever it is."""
    at = F.instr(text, part)
    rest = F.substring(text, at + F.length(part), F.length(text))
    return F.when(at > 0, F.concat(F.substring(text, F.lit(1), at - 1), rest)).otherwise(text)


def subject_name(name: Column, label: Column) -> Column:
    """Subject of a frame name ``<label>_<subject>_f<digits>.jpg``."""
    without_label = drop_first(file_stem(name), F.concat(label, F.lit("_")))
    subject = F.regexp_replace(without_label, r"_f\d+$", "")
    return F.coalesce(F.nullif(subject, F.lit("")), F.lit("unknown"))


def frame_name(label: Column, stem: Column, index: Column) -> Column:
    return F.format_string("%s_%s_f%06d.jpg", label, stem, index)


def sampling_step(source_fps: Column, target_fps: Column | float) -> Column:
    """Keep every n-th frame: the rate ratio, rounded half to even, at least 1."""
    target = target_fps if isinstance(target_fps, Column) else F.lit(float(target_fps))
    return F.greatest(F.lit(1), F.bround(source_fps / target).cast("int"))


def sampled(index: Column, source_fps: Column, target_fps: Column | float) -> Column:
    return index % sampling_step(source_fps, target_fps) == 0
