"""Image, video and depth references: views, requests, decoding through a pluggable decoder, and geometry."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.sources.schema import FRAME_REF


def views_map(df: DataFrame, prefix: str = "images", name: str | None = None) -> DataFrame:
    """Gather the columns of one family (``images_1``, ...) into a map from view to reference; absent ones stay out."""
    columns = [c for c in df.columns if c.startswith(prefix)]
    entries = F.array(*(F.struct(F.lit(c).alias("key"), F.col(c).cast(FRAME_REF).alias("value")) for c in columns)) if columns else F.expr(f"cast(array() as array<struct<key:string,value:{FRAME_REF}>>)")
    kept = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, kept.alias(name or prefix))


def select_views(views: Column, prefix: str = "images", wanted: Sequence[str] | None = None, limit: int | None = None) -> Column:
    """Names of the views to load: an explicit list in its own order, or all of a family in lexicographic order
    (``images_10`` before ``images_2``), at most ``limit``."""
    if wanted is not None:
        names = F.filter(F.array(*map(F.lit, wanted)), lambda k: F.map_contains_key(views, k))
    else:
        names = F.array_sort(F.filter(F.map_keys(views), lambda k: k.startswith(prefix)))
    return F.slice(names, 1, limit) if limit else names


def view_mask(views: Column, count: int, prefix: str = "images") -> Column:
    """Whether views 1 to ``count`` are there."""
    return F.transform(F.sequence(F.lit(1), F.lit(count)), lambda i: F.map_contains_key(views, F.concat(F.lit(prefix + "_"), i.cast("string"))))


def pad_nulls(values: Column, count: int) -> Column:
    """Extended with nulls to ``count`` places."""
    return F.concat(values, F.array_repeat(F.lit(None), F.greatest(F.lit(0), F.lit(count) - F.size(values))))


def join_url(prefix: Column, url: Column) -> Column:
    """The url below its prefix; an absolute url, a url with a scheme or an empty prefix leaves it as it is."""
    bare = F.rtrim(prefix, F.lit("/"))
    return F.when(F.coalesce(prefix, F.lit("")).isin("") | url.rlike(r"^(/|[A-Za-z][A-Za-z0-9+.-]*://)"), url).otherwise(F.concat(bare, F.lit("/"), url))


def media_requests(frames: DataFrame, keys: Sequence[str] = ("dataset", "episode_id", "frame_index"), views: str = "images", prefix: str = "images", wanted: Sequence[str] | None = None, limit: int | None = None) -> DataFrame:
    """One row per frame and view: keys, ``place``, ``view``, ``type``, ``url``, ``frame_idx``. Filter frames first:
    only what is asked for is decoded."""
    names = select_views(F.col(views), prefix, wanted, limit)
    named = frames.select(*keys, F.col(views).alias("__v"), F.posexplode(names).alias("place", "view"))
    ref = F.element_at("__v", F.col("view"))
    return named.select(*keys, "place", "view", ref["type"].alias("type"), ref["url"].alias("url"), F.coalesce(ref["frame_idx"], F.lit(0)).alias("frame_idx"))


def requests_by_url(requests: DataFrame) -> DataFrame:
    """One row per file: its type and the sorted distinct frames wanted, so that each video is decoded once."""
    return requests.select("type", "url", "frame_idx").distinct().groupBy("type", "url").agg(F.array_sort(F.collect_list("frame_idx")).alias("frames"))


Decoder = Callable[[str, bytes, list[int]], Iterator[tuple[int, bytes]]]


def decode(by_url: DataFrame, files: DataFrame, decoder: Decoder) -> DataFrame:
    """``url, frame_idx, pixels`` of all requests. ``files(path, content)`` is a binary file scan; ``decoder(type,
    content, frames)`` yields (frame, pixels) and runs once per file in an Arrow batch."""
    import pyarrow as pa

    joined = by_url.join(files.select(F.col("path").alias("url"), "content"), "url").select("type", "url", "content", "frames")

    def run(batches):
        for batch in batches:
            for kind, url, content, frames in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                found = list(decoder(kind, content, frames))
                yield pa.RecordBatch.from_arrays([pa.array([url] * len(found), pa.string()), pa.array([i for i, _ in found], pa.int32()), pa.array([p for _, p in found], pa.binary())], names=["url", "frame_idx", "pixels"])

    return joined.mapInArrow(run, "url string, frame_idx int, pixels binary")


def decode_paths(by_url: DataFrame, decoder: Decoder) -> DataFrame:
    """Like :func:`decode`, but only paths move: each file is opened where its requests are, through Arrow's
    filesystems. For files of any size in stores that executors can open; otherwise a scan of them goes to ``decode``."""
    import pyarrow as pa
    from pyarrow import fs

    def run(batches):
        for batch in batches:
            for kind, url, frames in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                store, path = (fs.LocalFileSystem(), "/" + url.removeprefix("file:").lstrip("/")) if url.startswith(("file:", "/")) else fs.FileSystem.from_uri(url)
                with store.open_input_stream(path) as stream:
                    found = list(decoder(kind, stream.read(), frames))
                yield pa.RecordBatch.from_arrays([pa.array([url] * len(found), pa.string()), pa.array([i for i, _ in found], pa.int32()), pa.array([p for _, p in found], pa.binary())], names=["url", "frame_idx", "pixels"])

    return by_url.select("type", "url", "frames").mapInArrow(run, "url string, frame_idx int, pixels binary")


def _netpbm(content: bytes) -> Iterator[tuple[int, int, int, bytes]]:
    """(width, height, maximum, samples) of every image of a binary netpbm file; several images make a video."""
    at = 0
    while at < len(content):
        head: list[bytes] = []
        while len(head) < 4:  # magic, width, height, maximum, with comments between them
            while content[at : at + 1].isspace():
                at += 1
            if content[at : at + 1] == b"#":
                at = content.index(b"\n", at)
                continue
            end = at
            while end < len(content) and not content[end : end + 1].isspace():
                end += 1
            if end == at:
                raise ValueError("the netpbm header is cut short")
            head.append(content[at:end])
            at = end
        if head[0] not in (b"P5", b"P6"):
            raise ValueError("not a binary netpbm file")
        width, height, most = (int(x) for x in head[1:])
        at += 1
        size = width * height * (3 if head[0] == b"P6" else 1) * (2 if most > 255 else 1)
        if at + size > len(content):
            raise ValueError("the netpbm file is cut short")
        yield width, height, most, content[at : at + size]
        at += size
        while content[at : at + 1].isspace():
            at += 1


def netpbm_decoder(kind: str, content: bytes, frames: list[int]) -> Iterator[tuple[int, bytes]]:
    """Frames of uncompressed images and videos: PPM (8-bit RGB) and PGM (8 or 16-bit grey, as for depth), one after
    the other in a file. ``pixels`` are the samples, 16-bit ones little-endian. An image is its frame 0; a frame
    beyond the end has no pixels, and decoding stops at the last frame asked for."""
    wanted = set(frames)
    for i, (_, _, most, samples) in enumerate(_netpbm(content)):
        if i in wanted:
            swapped = bytearray(samples)
            if most > 255:
                swapped[0::2], swapped[1::2] = samples[1::2], samples[0::2]
            yield i, bytes(swapped)
        if i >= max(wanted, default=-1):
            return


def library_decoder(kind: str, content: bytes, frames: list[int]) -> Iterator[tuple[int, bytes]]:
    """Netpbm files as above; other images through Pillow and other videos and depth videos (16-bit grey) through PyAV,
    where these are installed."""
    if content[:2] in (b"P5", b"P6"):
        yield from netpbm_decoder(kind, content, frames)
    elif kind == "image":
        import io

        from PIL import Image

        yield 0, Image.open(io.BytesIO(content)).convert("RGB").tobytes()
    else:
        import io

        import av

        wanted, shape = set(frames), "gray16le" if kind == "depth" else "rgb24"
        with av.open(io.BytesIO(content)) as video:
            for i, frame in enumerate(video.decode(video=0)):
                if i in wanted:
                    yield i, frame.to_ndarray(format=shape).tobytes()
                if i >= max(wanted, default=-1):
                    return


def zip_views(*views: Column, names: Sequence[str] | None = None, strict: bool = True) -> Column:
    """Arrays of views side by side, place by place. ``strict``: arrays of several lengths raise; otherwise the
    shortest ends the others."""
    sizes = [F.size(v) for v in views]
    shortest = F.least(*sizes) if len(sizes) > 1 else sizes[0]
    longest = F.greatest(*sizes) if len(sizes) > 1 else sizes[0]
    cut = F.arrays_zip(*(F.slice(v, F.lit(1), shortest).alias(n) for v, n in zip(views, names or [f"view_{i}" for i in range(len(views))], strict=True)))
    return F.when(shortest == longest, cut).otherwise(F.raise_error(F.lit("views of several lengths"))) if strict else cut


def per_view(values: Column, functions: Callable[[Column], Column] | Sequence[Callable[[Column], Column]]) -> Column:
    """A function of every view, or one function for each place (the last one for all further places)."""
    if callable(functions):
        return F.transform(values, functions)
    out = lambda v, i, rest: rest[0](v) if len(rest) == 1 else F.when(i == len(functions) - len(rest), rest[0](v)).otherwise(out(v, i, rest[1:]))
    return F.transform(values, lambda v, i: out(v, i, list(functions)))


def passthrough_decoder(kind: str, content: bytes, frames: list[int]) -> Iterator[tuple[int, bytes]]:
    """The whole file for every frame asked for: for tests and for images that are decoded later."""
    for i in frames:
        yield i, content


def attach_media(frames: DataFrame, requests: DataFrame, pixels: DataFrame, keys: Sequence[str] = ("dataset", "episode_id", "frame_index"), count: int | None = None, name: str = "rgb_data") -> DataFrame:
    """Each frame's decoded views as an array in view order, padded with nulls to ``count``."""
    joined = requests.join(pixels, ["url", "frame_idx"], "left").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("place", "pixels"))).alias("__m"))
    values = F.transform("__m", lambda m: m["pixels"])
    out = frames.join(joined, list(keys), "left").withColumn(name, F.coalesce(values, F.expr("cast(array() as array<binary>)"))).drop("__m")
    return out.withColumn(name, pad_nulls(F.col(name), count)) if count else out


def square_padding(width: Column, height: Column) -> Column:
    """Geometry of padding to a square: side and the offsets of the original."""
    side = F.greatest(width, height)
    return F.struct(side.alias("side"), F.floor((side - width) / 2).cast("int").alias("left"), F.floor((side - height) / 2).cast("int").alias("top"))


def fit_padding(width: Column, height: Column, target_width: int, target_height: int) -> Column:
    """Geometry of resizing into a target with centred padding: new size (rounded half to even) and offsets."""
    ratio = F.least(F.lit(float(target_width)) / width, F.lit(float(target_height)) / height)
    w, h = F.bround(width * ratio, 0).cast("int"), F.bround(height * ratio, 0).cast("int")
    return F.struct(w.alias("width"), h.alias("height"), F.floor((F.lit(target_width) - w) / 2).cast("int").alias("left"), F.floor((F.lit(target_height) - h) / 2).cast("int").alias("top"))


def image_path(root: str, run: Column, step: Column, view: Column) -> Column:
    """Where a request's image is kept for inspection: ``root/run/step_view.png``."""
    return F.concat_ws("/", F.lit(root.rstrip("/")), run.cast("string"), F.concat(step.cast("string"), F.lit("_"), view.cast("string"), F.lit(".png")))
