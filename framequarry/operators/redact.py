"""Redaction of images by any detector: decode, detect, blur, encode, all within the task that read the image.

A detector is a function without arguments that loads the model and returns `detect`, called with a list
of pictures (arrays of height x width x 3, BGR) and giving per picture a list of
(class name, confidence, x1, y1, x2, y2). It is loaded once per task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, types as T

from ..functions.boxes import BLUR_KERNEL, KIND_PATTERNS, MIN_CONFIDENCE
from ..sources.requests import Requests
from ..sources.store import Store, extended, named_rows, pieces, problem

Detection = tuple[str, float, float, float, float, float]
Detector = Callable[[], Callable[[list], list[Sequence[Detection]]]]

# Fixed value: images per detector call.
BATCH = 16
# Lines of the largest blur matrices that are kept (128 KB each), and how many of them and of class names are.
KEPT_LINES, KEPT = 128, 64


class Kept(dict):
    """Results of a function by its arguments, a bounded number of them; each task starts with none."""

    def __init__(self, make: Callable):
        super().__init__()
        self.make = make

    def __missing__(self, key: tuple):
        if len(self) >= KEPT:
            self.clear()
        self[key] = self.make(*key)
        return self[key]

    def __reduce__(self):
        return Kept, (self.make,)


@dataclass(frozen=True)
class Codec:
    """`decode` gives a picture or None for bytes that are none; `encode` gives bytes or None."""

    decode: Callable[[bytes], object]
    encode: Callable[[object], bytes | None]


def pixmap_codec() -> Codec:
    """Binary portable pixmaps (`P6`), which need no image library."""

    def decode(data):
        import re

        import numpy as np

        head = re.match(rb"P6\s+(\d+)\s+(\d+)\s+255\s", data)
        if not head:
            return None
        width, height = int(head[1]), int(head[2])
        body = np.frombuffer(data, np.uint8, offset=head.end())
        if width * height == 0 or body.size != width * height * 3:
            return None
        return body.reshape(height, width, 3)[:, :, ::-1]

    def encode(picture):
        height, width = picture.shape[:2]
        return b"P6 %d %d 255\n" % (width, height) + picture[:, :, ::-1].tobytes()

    return Codec(decode, encode)


def _blur_matrix(size: int, kernel: int):
    """Weights of every input line for every output line, borders mirrored without repeating the edge."""
    import numpy as np

    sigma = 0.3 * ((kernel - 1) * 0.5 - 1) + 0.8
    steps = np.arange(kernel) - kernel // 2
    weights = np.exp(-(steps**2) / (2 * sigma * sigma))
    matrix = np.zeros((size, size))
    if size == 1:
        return matrix + 1
    period = 2 * (size - 1)
    source = np.abs(np.arange(size)[:, None] + steps) % period
    source = np.where(source < size, source, period - source)
    np.add.at(matrix, (np.arange(size)[:, None], source), weights / weights.sum())
    return matrix


_MATRICES = Kept(_blur_matrix)


def gaussian_blur(region, kernel: int):
    """Gaussian blur of a picture region, as one product per axis."""
    import numpy as np

    height, width, bands = region.shape
    rows, columns = (_MATRICES[n, kernel] if n <= KEPT_LINES else _blur_matrix(n, kernel) for n in (height, width))
    out = rows.dot(region.astype(np.float64).reshape(height, -1)).reshape(height, width, bands)
    out = columns.dot(out.transpose(1, 0, 2).reshape(width, -1)).reshape(width, height, bands).transpose(1, 0, 2)
    return np.rint(out).clip(0, 255).astype(region.dtype)


def whole_boxes(boxes: Sequence[Sequence[float]], width: int, height: int):
    """Boxes in whole pixels inside a picture, one row each; those with nothing left are dropped."""
    import numpy as np

    edges = np.rint(np.asarray(boxes, float).reshape(-1, 4))
    if not np.isfinite(edges).all():
        raise ValueError("a box is not finite")
    edges = edges.clip(0, [width, height, width, height]).astype(int)
    return edges[(edges[:, 2:] > edges[:, :2]).all(axis=1)]


def blurred(picture, boxes: Sequence[Sequence[float]], kernel: int = BLUR_KERNEL):
    """Copy of the picture with every box blurred, one after the other."""
    out = picture.copy()
    for left, top, right, bottom in whole_boxes(boxes, out.shape[1], out.shape[0]):
        out[top:bottom, left:right] = gaussian_blur(out[top:bottom, left:right], kernel | 1)
    return out


def kind_of(class_name: str | None) -> str | None:
    """`boxes.detection_kind` of one name; a model has few class names."""
    import pyarrow as pa
    import pyarrow.compute as pc

    name = pc.utf8_lower(pa.scalar(class_name, pa.string()))
    return next((kind for kind, pattern in KIND_PATTERNS.items() if pc.match_substring_regex(name, pattern).as_py()), None)


_KINDS = Kept(kind_of)


def sure_boxes(detections: Sequence[Detection], min_confidence: float) -> tuple[dict[str, int], list]:
    """Number of detections per kind, and the boxes to blur: `detections.kept_detections` for one picture."""
    counts, boxes = dict.fromkeys(KIND_PATTERNS, 0), []
    for name, confidence, *box in detections:
        if confidence >= min_confidence and (kind := _KINDS[name,]):
            counts[kind] += 1
            boxes.append(tuple(box))
    return counts, boxes


def redact_batch(contents: list, detect, codec: Codec, min_confidence: float, kernel: int) -> list[dict]:
    """Per content: clean bytes, counts and size, or an error. A failing detector fails its whole batch."""
    results: list[dict] = [{"error": "image: not readable"} for _ in contents]
    pictures = {}
    for i, data in enumerate(contents):
        if isinstance(data, Exception):
            results[i] = {"error": f"image: {problem(data)}"}
            continue
        try:
            picture = None if data is None else codec.decode(data)
        except Exception as error:  # noqa: BLE001 - a broken file is a failed row
            results[i] = {"error": problem(error)}
            continue
        if picture is not None:
            pictures[i] = picture
    if not pictures:
        return results
    try:
        found = detect(list(pictures.values()))
    except Exception as error:  # noqa: BLE001
        for i in pictures:
            results[i] = {"error": f"detector: {problem(error)}"}
        return results
    if len(found) != len(pictures):
        for i in pictures:
            results[i] = {"error": f"detector: {len(found)} answers for {len(pictures)} pictures"}
        return results
    for (i, picture), detections in zip(pictures.items(), found):
        try:
            results[i] = redacted(picture, detections, codec, min_confidence, kernel)
        except Exception as error:  # noqa: BLE001 - a box or codec that fails costs its own row
            results[i] = {"error": f"redaction: {problem(error)}"}
    return results


def redacted(picture, detections: Sequence[Detection], codec: Codec, min_confidence: float, kernel: int) -> dict:
    """Clean bytes, counts and size of one picture."""
    counts, boxes = sure_boxes(detections, min_confidence)
    clean = codec.encode(blurred(picture, boxes, kernel) if boxes else picture)
    if clean is None:
        return {"error": "image: not encodable"}
    if not isinstance(clean, (bytes, bytearray)):
        raise TypeError(f"the codec gave {type(clean).__name__}, not bytes")
    height, width = picture.shape[:2]
    return {"clean": bytes(clean), "faces": counts["face"], "plates": counts["plate"], "width": width, "height": height, "error": None}


_RESULT = [("faces", T.LongType()), ("plates", T.LongType()), ("width", T.LongType()), ("height", T.LongType())]


def _arrays(results: list[dict]) -> dict:
    import pyarrow as pa

    columns = {name: pa.array([r.get(name) for r in results], pa.int64()) for name, _ in _RESULT}
    return {**columns, "error": pa.array([r["error"] for r in results], pa.string())}


def _result_schema(df: DataFrame, *more: T.StructField) -> T.StructType:
    fields = [T.StructField(n, t) for n, t in _RESULT] + [T.StructField("error", T.StringType())]
    return T.StructType(df.schema.fields + fields + list(more))


def redact_contents(
    df: DataFrame, content: str, detector: Detector, codec: Codec,
    min_confidence: float = MIN_CONFIDENCE, kernel: int = BLUR_KERNEL, batch: int = BATCH,
) -> DataFrame:
    """Redact contents held in a column: adds faces, plates, width, height, error and `clean`."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        detect = detector()
        for rows in batches:
            for part in pieces(rows, batch):
                results = redact_batch(part.column(content).to_pylist(), detect, codec, min_confidence, kernel)
                yield extended(part, {**_arrays(results), "clean": pa.array([r.get("clean") for r in results], pa.binary())})

    return df.mapInArrow(run, _result_schema(df, T.StructField("clean", T.BinaryType())))


def redact_objects(
    df: DataFrame, raw_uri: str, clean_uri: str, detector: Detector, codec: Codec, dry_run: bool = False,
    raw_lines: str | None = None, clean_lines: str | None = None,
    min_confidence: float = MIN_CONFIDENCE, kernel: int = BLUR_KERNEL, batch: int = BATCH,
) -> DataFrame:
    """Read, redact and write the images rows name; only names and counts leave the task.

    Where `raw_lines` is not NULL, that lane file is carried over unchanged. A failed write fails its row.
    """

    def run(batches: Iterator) -> Iterator:
        store, detect = Store(), detector()

        def fetch(uri):
            try:
                return store.read(uri)
            except Exception as error:  # noqa: BLE001 - an unreadable object is a failed row, with its reason
                return error

        def finish(job):
            row, result = job
            if result["error"] is None and not dry_run:
                try:
                    store.write(row[clean_uri], result["clean"])
                    if raw_lines and row[raw_lines] is not None:
                        store.copy(row[raw_lines], row[clean_lines])
                except Exception as error:  # noqa: BLE001
                    return {"error": problem(error)}
            return {k: v for k, v in result.items() if k != "clean"}

        used = [name for name in (raw_uri, clean_uri, raw_lines, clean_lines) if name]
        with Requests() as reads, Requests() as writes:
            for rows in batches:
                for part in pieces(rows, batch):
                    named = named_rows(part, *used)
                    contents = reads.map(fetch, [r[raw_uri] for r in named])
                    results = redact_batch(contents, detect, codec, min_confidence, kernel)
                    yield extended(part, _arrays(writes.map(finish, list(zip(named, results)))))

    return df.mapInArrow(run, _result_schema(df))
