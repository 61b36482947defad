"""Path and URI expressions. All take and return columns; a NULL path gives NULL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import first_word

ColumnOrName = Column | str

# Object names and suffixes of the catalogue layout.
IMAGE_DIR = "images"
LABEL_DIR = "label"
RAW_LABEL_DIR = "lines"
LABEL_SUFFIX = ".lines.json"
TEXT_LABEL_SUFFIX = ".lines.txt"

_EXTENSION = r"(?s)^((?:.*/)?\.*[^/.][^/]*)\.[^/.]*$"


def _c(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def stem(path: ColumnOrName) -> Column:
    """Path without the last extension of its last segment; leading dots start no extension."""
    return F.regexp_replace(_c(path), _EXTENSION, "$1")


def basename(path: ColumnOrName) -> Column:
    return F.substring_index(_c(path), "/", -1)


def frame_id(path: ColumnOrName) -> Column:
    return stem(basename(path))


def sequence_id(path: ColumnOrName) -> Column:
    """Folder part of a relative path, '' at the top level."""
    return F.regexp_replace(_c(path), r"/*[^/]*$", "")


def image_id(dataset: ColumnOrName, rel_path: ColumnOrName) -> Column:
    return F.concat(_c(dataset), F.lit("/"), stem(rel_path))


def uri_bucket(uri: ColumnOrName, scheme: str = "gs") -> Column:
    """Bucket of an object URI, NULL for another scheme or an empty bucket."""
    return F.nullif(F.regexp_extract(_c(uri), f"(?s)^{scheme}://([^/]+)(?:/.*)?$", 1), F.lit(""))


def uri_object(uri: ColumnOrName, scheme: str = "gs") -> Column:
    """Object name of an object URI ('' for a bare bucket), NULL where `uri_bucket` is NULL."""
    name = F.regexp_extract(_c(uri), f"(?s)^{scheme}://[^/]+/(.*)$", 1)
    return F.when(uri_bucket(uri, scheme).isNotNull(), name)


def trimmed(part: ColumnOrName) -> Column:
    """Part without slashes at both ends; NULL where there was nothing to begin with."""
    value = F.nullif(_c(part), F.lit(""))
    return F.regexp_replace(value, r"^/+|/+$", "")


def join_path(root: ColumnOrName, *parts: ColumnOrName) -> Column:
    """Root without trailing slashes, then every non-empty part without outer slashes."""
    head = F.regexp_replace(_c(root), r"/+$", "")
    return F.concat_ws("/", head, *[trimmed(p) for p in parts])


def leaf(split: ColumnOrName, category: ColumnOrName) -> Column:
    """Output folder of a sample: the split, then the category if there is one."""
    return F.concat_ws("/", _c(split), F.nullif(_c(category), F.lit("")))


def image_out(split: ColumnOrName, category: ColumnOrName, rel_path: ColumnOrName) -> Column:
    return F.concat_ws("/", leaf(split, category), F.lit(IMAGE_DIR), _c(rel_path))


def label_out(split: ColumnOrName, category: ColumnOrName, rel_path: ColumnOrName) -> Column:
    name = F.concat(stem(rel_path), F.lit(LABEL_SUFFIX))
    return F.concat_ws("/", leaf(split, category), F.lit(LABEL_DIR), name)


def manifest_out(split: ColumnOrName, category: ColumnOrName) -> Column:
    folder = leaf(split, category)
    return F.concat(folder, F.lit("/"), basename(folder), F.lit(".txt"))


def category_name(list_path: ColumnOrName) -> Column:
    """`test0_normal.txt` gives `normal`; without text after the first `_`, the whole stem."""
    name = frame_id(list_path)
    return F.coalesce(F.nullif(F.regexp_extract(name, r"(?s)^[^_]*_(.*)$", 1), F.lit("")), name)


def list_entry(line: ColumnOrName) -> Column:
    """First whitespace-separated column of a list-file line, without leading slashes."""
    return F.regexp_replace(first_word(_c(line)), r"^/+", "")


def nested_under_driver(rel_path: ColumnOrName) -> Column:
    """Path repeated under its own first folder: `<driver>/<driver>/...`."""
    rel = _c(rel_path)
    return F.concat(F.substring_index(rel, "/", 1), F.lit("/"), rel)


def native_image_uri(root: ColumnOrName, rel_path: ColumnOrName, under_driver: ColumnOrName) -> Column:
    rel = _c(rel_path)
    return join_path(root, F.when(_c(under_driver), nested_under_driver(rel)).otherwise(rel))


def native_label_uri(root: ColumnOrName, rel_path: ColumnOrName, strategy: ColumnOrName) -> Column:
    """Text label of an image: next to it, nested under its driver, or under a named folder."""
    name = F.concat(stem(rel_path), F.lit(TEXT_LABEL_SUFFIX))
    where = _c(strategy)
    return (
        F.when(where == "alongside", join_path(root, name))
        .when(where == "nested", join_path(root, F.substring_index(_c(rel_path), "/", 1), name))
        .otherwise(join_path(root, where, name))
    )


def without_image_dir(path: ColumnOrName) -> Column:
    return F.regexp_replace(_c(path), f"^{IMAGE_DIR}/", "")


def json_label_path(path: ColumnOrName) -> Column:
    return F.concat(F.lit("labels/"), stem(without_image_dir(path)), F.lit(LABEL_SUFFIX))


def below(uri: ColumnOrName, root: str) -> Column:
    """Part of `uri` below `root`."""
    return F.substr(_c(uri), F.lit(len(root.rstrip("/")) + 2))


def user_image_id(uri: ColumnOrName, raw_root: str) -> Column:
    return F.concat(F.lit("user/"), stem(below(uri, raw_root)))


def swap_root(uri: ColumnOrName, old_root: str, new_root: str) -> Column:
    """Same relative path under another root; a URI outside `old_root` is left alone."""
    old, new = old_root.rstrip("/") + "/", new_root.rstrip("/") + "/"
    return F.when(F.startswith(_c(uri), F.lit(old)), F.concat(F.lit(new), below(uri, old_root))).otherwise(_c(uri))


def lines_uri(image_uri: ColumnOrName) -> Column:
    """Lane file that belongs to a raw or clean user image."""
    moved = F.regexp_replace(_c(image_uri), f"(?s)^(.*?)/{IMAGE_DIR}/", f"$1/{RAW_LABEL_DIR}/")
    return F.concat(stem(moved), F.lit(LABEL_SUFFIX))


def _head(rel: ColumnOrName) -> Column:
    return F.substring_index(_c(rel), f"/{IMAGE_DIR}/", 1)


def path_user(rel: ColumnOrName) -> Column:
    return F.substring_index(_head(rel), "/", 1)


def path_session(rel: ColumnOrName) -> Column:
    return F.regexp_extract(_head(rel), r"(?s)^[^/]*/(.*)$", 1)


def path_frame(rel: ColumnOrName) -> Column:
    return frame_id(F.regexp_extract(_c(rel), f"(?s)^.*?/{IMAGE_DIR}/(.*)$", 1))


def is_user_image(uri: ColumnOrName) -> Column:
    """Objects the redaction job takes: below an image folder, with an image suffix in any case."""
    return F.contains(_c(uri), F.lit(f"/{IMAGE_DIR}/")) & F.lower(_c(uri)).rlike(r"\.(jpe?g|png)$")


def event_dataset(object_name: ColumnOrName) -> Column:
    """Dataset a descriptor upload is about; NULL (skip) when the name starts with a dot or is empty."""
    return F.nullif(F.substring_index(basename(object_name), ".", 1), F.lit(""))
