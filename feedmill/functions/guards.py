"""Record guards and the derived fields shared by the log reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedmill.functions.values import strict_int

# Fixed values of the client log.
PLAY_ACTION = "799"
FEED_PAGE = "10000756"
DETAIL_PAGE = "10000376"
TAB_PAGE = "10000789"
FIND_ROOT = "10000700"
FIND_REFERRERS = ("231553", "231091", "231278")
CLIENT_SUFFIX = {"android": "5010", "ios": "3010"}
DIVERSION_CODE = "4000"
LONG_PLAY_MS = 3000
MEMBER_UID_LENGTH = 11


def is_member(uid: Column) -> Column:
    """Guests carry a longer uid than members."""
    return F.length(uid) <= MEMBER_UID_LENGTH


def is_play(action: Column) -> Column:
    return action == PLAY_ACTION


def on_page(uicode: Column, pages: Iterable[str]) -> Column:
    return uicode.isin(*pages)


def came_from_find(previous_id: Column, root_uicode: Column) -> Column:
    return previous_id.isin(*FIND_REFERRERS) & (root_uicode == FIND_ROOT)


def client(source: Column) -> Column:
    """android, ios, other; NULL when the field is too short to hold a suffix."""
    tail = F.right(source, F.lit(4))
    named = F.when(tail == CLIENT_SUFFIX["android"], "android").when(
        tail == CLIENT_SUFFIX["ios"], "ios"
    )
    return F.when(F.length(source) >= 4, F.coalesce(named, F.lit("other")))


def is_entry_video(index: Column) -> Column:
    """True for the video a user clicked: index absent, empty, null, NULL or 0."""
    return index.isNull() | index.isin("", "null", "NULL", "0")


def not_recommended(index: Column) -> Column:
    """True for the entry video and for a number below one; False when unreadable."""
    number = strict_int(index, "bigint")
    return is_entry_video(index) | F.coalesce(number < 1, F.lit(False))


def feed_depth(kind: Column, page: Column, index: Column) -> Column:
    """Position in the feed; pages count from 0 on Android and from 1 on iOS."""
    # Wide arithmetic: a wild page number must not stop the job.
    page_no, index_no = strict_int(page).cast("bigint"), strict_int(index).cast("bigint")
    return F.when(kind == "android", page_no * 10 + index_no).when(
        kind == "ios", (page_no - 1) * 10 + index_no
    )


def user_tail(uid: Column) -> Column:
    """Third- and second-last character; NULL for a uid shorter than three."""
    return F.when(F.length(uid) >= 3, F.substring(uid, -3, 2))
