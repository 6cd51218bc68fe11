"""Image kernels on raw pixels, for pandas UDFs over a binary column.

A picture is bytes of height x width x 3 (RGB). Coordinates are thousandths of the size. Kernels are NumPy only; decoding of
file formats is left to the caller.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pixels(data: bytes, height: int, width: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(height, width, 3)


def to_pixel(coordinate: int, size: int) -> int:
    return int(coordinate) * size // 1000


def region(image: np.ndarray, box: list[int] | None) -> np.ndarray:
    """The part of a box [x1, y1, x2, y2], corners in any order; the whole without one."""
    if not box:
        return image
    h, w = image.shape[:2]
    (x1, x2), (y1, y2) = sorted(to_pixel(box[i], w) for i in (0, 2)), sorted(to_pixel(box[i], h) for i in (1, 3))
    return image[y1:y2, x1:x2]


def flipped(image: np.ndarray, direction: str) -> np.ndarray:
    return image[:, ::-1] if direction == "horizontal" else image[::-1]


def quarter_turned(image: np.ndarray, times: int) -> np.ndarray:
    """Turned clockwise by quarters."""
    return np.rot90(image, -times)


def brightened(image: np.ndarray, alpha: float = 1.0, beta: float = 0.0) -> np.ndarray:
    """abs(pixel * alpha + beta), rounded and held in range."""
    return np.clip(np.rint(np.abs(image.astype(np.float64) * alpha + beta)), 0, 255).astype(np.uint8)


def gray(image: np.ndarray) -> np.ndarray:
    """Luma of ITU-R 601-2, in the usual 16-bit fixed point."""
    r, g, b = (image[..., k].astype(np.uint32) for k in range(3))
    return ((r * 19595 + g * 38470 + b * 7471 + 0x8000) >> 16).astype(np.uint8)


def otsu(values: np.ndarray) -> int:
    """Threshold with the largest variance between the classes, the lowest of equally good ones."""
    n = np.bincount(values.ravel(), minlength=256).astype(np.float64)
    below, above = np.cumsum(n), n.sum() - np.cumsum(n)
    weighted = np.cumsum(n * np.arange(256))
    with np.errstate(invalid="ignore", divide="ignore"):
        between = below * above * (weighted / below - (weighted[-1] - weighted) / above) ** 2
    between = np.nan_to_num(between, nan=0.0, posinf=0.0)
    return int(between.argmax()) if between.max() > 0 else 0


def binarized(image: np.ndarray, threshold: int | None = None) -> np.ndarray:
    g = gray(image)
    return ((g > (otsu(g) if threshold is None else min(255, max(0, threshold)))) * 255).astype(np.uint8)


def edges(image: np.ndarray) -> np.ndarray:
    """Sobel magnitude, the largest made 255; the border mirrored."""
    g = np.pad(gray(image).astype(np.float64), 1, mode="symmetric")
    smooth = lambda a, axis: sum(w * np.take(a, range(k, a.shape[axis] - 2 + k), axis) for k, w in enumerate((1, 2, 1)))
    change = lambda a, axis: np.take(a, range(2, a.shape[axis]), axis) - np.take(a, range(a.shape[axis] - 2), axis)
    size = np.hypot(smooth(change(g, 1), 0), smooth(change(g, 0), 1))
    return (size / size.max() * 255 if size.max() > 0 else size).astype(np.uint8)


def color_at(image: np.ndarray, x: int, y: int) -> list[int]:
    h, w = image.shape[:2]
    return image[min(h - 1, to_pixel(y, h)), min(w - 1, to_pixel(x, w))].tolist()


def clusters(image: np.ndarray, k: int = 5) -> list[tuple[list[int], float]]:
    """The k most frequent colours in steps of eight, with their share; equally frequent ones by colour."""
    flat = (image.reshape(-1, 3) // 8 * 8).astype(np.int64)
    code, n = np.unique(flat[:, 0] << 16 | flat[:, 1] << 8 | flat[:, 2], return_counts=True)
    order = np.lexsort((code, -n))[:k]
    return [([int(c) >> 16, int(c) >> 8 & 255, int(c) & 255], float(m) / len(flat)) for c, m in zip(code[order], n[order])]


def color_mask(image: np.ndarray, rgb: list[int], tolerance: float) -> np.ndarray:
    return np.sqrt(((image.astype(np.float32) - np.array(rgb, np.float32)) ** 2).sum(axis=2)) <= tolerance


def labelled(mask: np.ndarray, diagonal: bool = False) -> tuple[np.ndarray, int]:
    """Connected parts of a mask, numbered by their first pixel: labels spread as minima until nothing changes."""
    h, w = mask.shape
    label = np.where(mask, np.arange(1, h * w + 1).reshape(h, w), 0)
    far = h * w + 1
    link = np.arange(far)
    beside = [(label[:, :-1], label[:, 1:]), (label[:-1], label[1:])]
    beside += [(label[:-1, :-1], label[1:, 1:]), (label[:-1, 1:], label[1:, :-1])] * diagonal
    pairs = np.concatenate([np.stack([a[both := (a > 0) & (b > 0)], b[both]]) for a, b in beside], axis=1)
    while pairs.shape[1]:
        low = np.minimum(link[pairs[0]], link[pairs[1]])
        before = link.copy()
        np.minimum.at(link, link[pairs[0]], low)
        np.minimum.at(link, link[pairs[1]], low)
        link = link[link]
        if (link == before).all():
            break
    roots = np.unique(link[label[mask]]) if mask.any() else np.empty(0, np.int64)
    number = np.zeros(far, np.int64)
    number[roots] = np.arange(1, len(roots) + 1)
    return number[link[label]] * mask, len(roots)


def components(mask: np.ndarray, least: int = 1, diagonal: bool = False) -> list[dict[str, float]]:
    """Box, area and centre of each connected part of at least ``least`` pixels, the largest first, then by place."""
    label, n = labelled(mask, diagonal)
    ys, xs = np.nonzero(mask)
    of = label[ys, xs] - 1
    area = np.bincount(of, minlength=n)
    out = []

    def extreme(values: np.ndarray, start: int, of_two: np.ufunc) -> np.ndarray:
        found = np.full(n, start)
        of_two.at(found, of, values)
        return found

    x1, y1 = extreme(xs, mask.shape[1], np.minimum), extreme(ys, mask.shape[0], np.minimum)
    x2, y2 = extreme(xs, -1, np.maximum), extreme(ys, -1, np.maximum)
    cx, cy = (np.bincount(of, weights=v, minlength=n) / np.maximum(area, 1) for v in (xs, ys))
    for k in np.lexsort((x1, y1, -area)):
        if area[k] >= least:
            out.append({"x1": int(x1[k]), "y1": int(y1[k]), "x2": int(x2[k]) + 1, "y2": int(y2[k]) + 1, "area": int(area[k]), "cx": float(cx[k]), "cy": float(cy[k])})
    return out


def matches(image: np.ndarray, template: np.ndarray, threshold: float = 0.8, most: int = 10) -> list[dict[str, float]]:
    """Places where a template fits by normalized correlation, the best first, without overlaps above 0.3 of its area."""
    a, t = gray(image).astype(np.float64), gray(template).astype(np.float64)
    th, tw = t.shape
    if th > a.shape[0] or tw > a.shape[1]:
        return []
    t = t - t.mean()
    view = np.lib.stride_tricks.sliding_window_view(a, (th, tw))
    shape = [a.shape[0] + th - 1, a.shape[1] + tw - 1]
    cross = np.fft.irfft2(np.fft.rfft2(a, shape) * np.fft.rfft2(t[::-1, ::-1], shape), shape)[th - 1 : a.shape[0], tw - 1 : a.shape[1]]
    spread = np.sqrt(np.maximum(view.var(axis=(2, 3)) * th * tw * (t**2).sum(), 0))
    score = np.divide(cross, spread, out=np.zeros_like(cross), where=spread > 1e-9)
    ys, xs = np.nonzero(score >= threshold)
    kept: list[dict[str, float]] = []
    for k in np.lexsort((xs, ys, -score[ys, xs])):
        x, y = int(xs[k]), int(ys[k])
        if all(max(0, tw - abs(x - m["x"])) * max(0, th - abs(y - m["y"])) <= 0.3 * tw * th for m in kept):
            kept.append({"x": x, "y": y, "score": round(float(score[y, x]), 4)})
            if len(kept) >= most:
                break
    return kept


def _over(kernel: Callable, result: T.DataType):
    """A pandas UDF of (bytes, height, width); null, or bytes that don't fit the size, give null."""

    def run(data: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
        def one(d: bytes | None, h: float, w: float) -> object:
            if d is None or pd.isna(h) or pd.isna(w) or h * w * 3 != len(d) or not len(d):
                return None
            out = kernel(pixels(d, int(h), int(w)))
            return out.tobytes() if isinstance(out, np.ndarray) else out

        return pd.Series([one(*x) for x in zip(data, height, width)], dtype=object)

    return F.pandas_udf(run, result)


def image_op(kernel: Callable[[np.ndarray], np.ndarray], data: Column, height: Column, width: Column) -> Column:
    """A kernel that gives a picture, as a column of bytes."""
    return _over(kernel, T.BinaryType())(data, height, width)


def hsv(image: np.ndarray) -> np.ndarray:
    """Hue in half degrees (0 to 179), saturation and value in 0 to 255."""
    rgb = image.astype(np.float64)
    top, low = rgb.max(axis=2), rgb.min(axis=2)
    spread = np.where(top > low, top - low, 1.0)
    r, g, b = (rgb[..., k] for k in range(3))
    sector = np.select([top == r, top == g], [(g - b) / spread, (b - r) / spread + 2], (r - g) / spread + 4)
    hue = np.where(top > low, sector * 30, 0.0) % 180
    saturation = np.where(top > 0, (top - low) / np.where(top > 0, top, 1.0) * 255, 0.0)
    return np.stack([np.rint(hue) % 180, np.rint(saturation), top], axis=2).astype(np.uint8)


def range_mask(image: np.ndarray, low: list[float], high: list[float], space: str = "hsv") -> np.ndarray:
    """Pixels whose channels all lie between the bounds; a hue range from above to below wraps around."""
    most = np.array([179 if space == "hsv" else 255, 255, 255])
    a, b = (np.clip(np.rint(x), 0, most) for x in (low, high))
    channels = (hsv(image) if space == "hsv" else image[..., ::-1]).astype(np.int64)
    held = (channels >= a) & (channels <= b)
    if space == "hsv" and a[0] > b[0]:
        held[..., 0] = (channels[..., 0] >= a[0]) | (channels[..., 0] <= b[0])
    return held.all(axis=2)


def range_boxes(image: np.ndarray, low: list[float], high: list[float], space: str = "hsv", least: float = 0, most: int = 50) -> list[list[int]]:
    """Boxes, in thousandths, of the connected parts in a colour range, from the left, then from the top; ``least`` up to 1 is a share of the pixels."""
    mask = range_mask(image, low, high, space)
    area = max(1, int(np.ceil(least * mask.size))) if least <= 1 else int(np.ceil(least))
    h, w = mask.shape
    found = sorted(components(mask, area, True), key=lambda c: (c["x1"], c["y1"]))[:most]
    return [[round(c["x1"] * 1000 / w), round(c["y1"] * 1000 / h), round(c["x2"] * 1000 / w), round(c["y2"] * 1000 / h)] for c in found]


def _drawn(image: np.ndarray, where: np.ndarray, rgb: list[int]) -> np.ndarray:
    out = image.copy()
    out[where] = rgb
    return out


def with_line(image: np.ndarray, x1: int, y1: int, x2: int, y2: int, rgb: list[int], thickness: int = 2) -> np.ndarray:
    """A line between two points: all pixels at most half the thickness from it."""
    h, w = image.shape[:2]
    ys, xs = np.mgrid[0:h, 0:w]
    ax, ay, bx, by = (float(min(to_pixel(c, n), n - 1)) for c, n in ((x1, w), (y1, h), (x2, w), (y2, h)))
    length = (bx - ax) ** 2 + (by - ay) ** 2
    along = np.clip(((xs - ax) * (bx - ax) + (ys - ay) * (by - ay)) / length, 0, 1) if length else np.zeros((h, w))
    away = np.hypot(xs - ax - along * (bx - ax), ys - ay - along * (by - ay))
    return _drawn(image, away <= thickness / 2, rgb)


def with_circle(image: np.ndarray, x: int, y: int, radius: int, rgb: list[int], thickness: int = 2) -> np.ndarray:
    """A circle around a point, its radius in thousandths of the shorter side."""
    h, w = image.shape[:2]
    ys, xs = np.mgrid[0:h, 0:w]
    away = np.hypot(xs - to_pixel(x, w), ys - to_pixel(y, h))
    return _drawn(image, np.abs(away - to_pixel(radius, min(h, w))) <= thickness / 2, rgb)


def with_box(image: np.ndarray, box: list[int], rgb: list[int], thickness: int = 2) -> np.ndarray:
    """The outline of a box, corners in any order."""
    (x1, x2), (y1, y2) = sorted((box[0], box[2])), sorted((box[1], box[3]))
    for line in ((x1, y1, x2, y1), (x2, y1, x2, y2), (x2, y2, x1, y2), (x1, y2, x1, y1)):
        image = with_line(image, *line, rgb, thickness)
    return image


def equalized(image: np.ndarray) -> np.ndarray:
    """Grayscale with its histogram equalized over the whole picture."""
    values = gray(image)
    upto = np.cumsum(np.bincount(values.ravel(), minlength=256))
    first = upto[np.flatnonzero(upto)[0]] if values.size else 0
    if not values.size or upto[-1] == first:
        return values
    return np.clip(np.rint((upto - first) * 255.0 / (upto[-1] - first)), 0, 255).astype(np.uint8)[values]


def top_colors(data: Column, height: Column, width: Column, k: int = 5) -> Column:
    row = T.ArrayType(T.StructType([T.StructField("rgb", T.ArrayType(T.IntegerType())), T.StructField("share", T.DoubleType())]))
    return _over(lambda im: [{"rgb": c, "share": s} for c, s in clusters(im, k)], row)(data, height, width)


def color_segments(data: Column, height: Column, width: Column, rgb: list[int], tolerance: float, least: int = 1) -> Column:
    row = T.ArrayType(T.StructType([*(T.StructField(k, T.IntegerType()) for k in ("x1", "y1", "x2", "y2", "area")), *(T.StructField(k, T.DoubleType()) for k in ("cx", "cy"))]))
    return _over(lambda im: components(color_mask(im, rgb, tolerance), least), row)(data, height, width)


def mime(data: Column, name: Column) -> Column:
    """MIME type by the first bytes, else by the extension."""
    head = F.hex(F.substring(data, 1, 12))
    ext = F.lower(F.regexp_extract(name, r"\.(\w+)$", 1))
    by_head = F.when(head.startswith("89504E470D0A1A0A"), "image/png").when(head.startswith("FFD8FF"), "image/jpeg").when(head.startswith("47494638"), "image/gif").when(head.startswith("52494646") & head.endswith("57454250"), "image/webp").when(head.startswith("424D"), "image/bmp")
    return F.coalesce(by_head, F.when(ext == "png", "image/png").when(ext.isin("jpg", "jpeg"), "image/jpeg").when(ext.isin("gif", "webp", "bmp"), F.concat(F.lit("image/"), ext)))


def data_url(data: Column, name: Column) -> Column:
    return F.concat(F.lit("data:"), F.coalesce(mime(data, name), F.lit("application/octet-stream")), F.lit(";base64,"), F.regexp_replace(F.base64(data), r"\s", ""))
