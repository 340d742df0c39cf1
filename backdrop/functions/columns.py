"""Column expressions for names, paths, session ids and binary fields.

All of them are built-in Spark functions, so they run inside whole-stage
codegen and Catalyst can push the predicates down.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values shared with the reference: the image extensions it accepts
# (compared case-insensitively), the session-id stamp, its display format and
# the END marker of the session protocol.
IMAGE_EXTENSIONS = (".png", ".jpg", ".jpeg")
STAMP_PYTHON = "%Y%m%d_%H%M%S"
STAMP_PATTERN = "yyyyMMdd_HHmmss"
DISPLAY_PATTERN = "dd/MM/yyyy HH:mm:ss"
END_MARKER = 0xFFFFFFFF

IMAGE_NAME_REGEX = r"\.(png|jpe?g)$"
# Case-insensitive glob for Spark's `pathGlobFilter` (which is case-sensitive).
IMAGE_GLOB = "*.{[pP][nN][gG],[jJ][pP][gG],[jJ][pP][eE][gG]}"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_image_name(filename) -> Column:
    """The name ends in .png, .jpg or .jpeg, in any letter case."""
    return F.lower(_c(filename)).rlike(IMAGE_NAME_REGEX)


def file_name(path) -> Column:
    """Last path component of a path or URI."""
    return F.regexp_extract(_c(path), r"([^/]*)$", 1)


def parent_name(path) -> Column:
    """Name of the directory holding a file, without a `key=` prefix."""
    return F.regexp_replace(F.regexp_extract(_c(path), r"([^/]*)/[^/]*$", 1), r"^session_id=", "")


def session_path(root: str, session_id, filename=None) -> Column:
    """``<root>/<session_id>[/<filename>]``."""
    parts = [F.lit(root.rstrip("/")), _c(session_id)]
    if filename is not None:
        parts.append(_c(filename))
    return F.concat_ws("/", *parts)


def frame_file_name(prefix, frame_id) -> Column:
    """``<prefix>_<frame_id>.jpg``, the name the camera side gives a frame."""
    return F.format_string("%s_%d.jpg", _c(prefix), _c(frame_id))


def new_session_id(now: datetime | None = None, suffix: str | None = None, unique: bool = True) -> str:
    """One id per job: ``yyyyMMdd_HHmmss`` plus ``_`` and 8 hex digits.

    A second-resolution stamp alone collides when two jobs start in the same
    second, so a random suffix is added unless ``unique=False``. Computed
    once on the driver and used as a literal, so every row of a job carries
    the same id.
    """
    import uuid
    stamp_text = (now or datetime.now()).strftime(STAMP_PYTHON)
    if suffix is None and unique:
        suffix = uuid.uuid4().hex[:8]
    return f"{stamp_text}_{suffix}" if suffix else stamp_text


def _fields(ts) -> list:
    t = _c(ts)
    return [F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), F.second(t)]


def stamp(ts) -> Column:
    """D1 as a column: ``yyyyMMdd_HHmmss`` of a timestamp.

    Built from the timestamp's fields: on a TIMESTAMP_NTZ no session time
    zone is involved (``date_format`` would go through one, and shift wall
    times that fall in a daylight-saving gap).
    """
    t = _c(ts)
    text = t.cast("string")  # 2024-01-02 03:04:05[.6]
    date, clock = F.translate(F.substring(text, 1, 10), "-", ""), F.translate(F.substring(text, 12, 8), ":", "")
    return F.when(F.year(t).between(0, 9999), F.concat(date, F.lit("_"), clock)).when(
        t.isNotNull(), F.format_string("%04d%02d%02d_%02d%02d%02d", *_fields(ts)))


def display_time(ts) -> Column:
    """``dd/MM/yyyy HH:mm:ss`` of a timestamp, from its fields."""
    y, mo, d, h, mi, sec = _fields(ts)
    return F.when(_c(ts).isNotNull(), F.format_string("%02d/%02d/%04d %02d:%02d:%02d", d, mo, y, h, mi, sec))


def session_started_at(session_id) -> Column:
    """The time encoded in the first two ``_`` fields of an id, or NULL.

    Built field by field as a TIMESTAMP_NTZ, so no session time zone (and no
    daylight-saving gap) can shift it; impossible dates give NULL.
    """
    head = F.substring_index(_c(session_id), "_", 2)
    well_formed = head.rlike(r"^[0-9]{8}_[0-9]{6}$")

    def part(pos, n):
        return F.substring(head, pos, n).cast("int")

    ts = F.try_make_timestamp_ntz(part(1, 4), part(5, 2), part(7, 2), part(10, 2), part(12, 2), part(14, 2))
    return F.when(well_formed, ts)


def session_display_time(session_id) -> Column:
    """``dd/MM/yyyy HH:mm:ss`` of the id's time, the raw id when it has none."""
    text, started = _c(session_id), session_started_at(session_id)
    part = lambda pos, n: F.substring(text, pos, n)
    shown = F.concat(part(7, 2), F.lit("/"), part(5, 2), F.lit("/"), part(1, 4), F.lit(" "), part(10, 2), F.lit(":"), part(12, 2), F.lit(":"), part(14, 2))
    # A 60th second is the next minute's first.
    return F.when(started.isNull(), text).when(part(14, 2) == "60", display_time(started)).otherwise(shown)


def uint32_be(binary, pos: int | Column = 1) -> Column:
    """D3: unsigned big-endian 32-bit integer at 1-based byte ``pos``, as bigint."""
    p = pos if isinstance(pos, Column) else F.lit(pos)
    return F.conv(F.hex(F.substring(_c(binary), p, F.lit(4))), 16, 10).cast("bigint")


def uint32_be_bytes(value) -> Column:
    """D3 inverse: four big-endian bytes of a bigint in 0..2^32-1."""
    return F.unhex(F.lpad(F.hex(_c(value)), 8, "0"))


def utf8_bytes(text) -> Column:
    return F.encode(_c(text), "UTF-8")


def utf8_text(binary) -> Column:
    """Strict UTF-8 decode; NULL when the bytes are not valid UTF-8
    (``decode`` would fail the query under ANSI mode)."""
    return F.try_validate_utf8(_c(binary).cast("string"))


def has_payload(payload) -> Column:
    """A frame with a zero-size payload counts as no frame."""
    return F.coalesce(F.octet_length(_c(payload)) > 0, F.lit(False))


def json_line(*cols) -> Column:
    """One JSON object per row (a line of a JSON-lines feed)."""
    return F.to_json(F.struct(*[_c(c) for c in cols]))


def frame_hex(data) -> Column:
    """Upper-case hex of frame bytes; a compact exact fingerprint for checks."""
    return F.hex(_c(data))


def frame_number(filename: str = "filename") -> Column:
    """The last run of digits in a file name as a number (``cam_11.png`` -> 11), NULL without digits."""
    return F.regexp_extract(filename, "([0-9]+)[^0-9]*$", 1).try_cast("bigint")
