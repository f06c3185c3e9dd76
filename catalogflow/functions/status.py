"""Capture status: blocked pages, error classes, result status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col, contains_any

# Phrases of blocked pages, failed captures and empty result pages.
BLOCKED_WORDS = ("captcha", "not a robot", "access denied", "verify you are human", "robot", "blocked")
BLOCKED_WORDS_A = (
    "ご迷惑をおかけしています",
    "お客様のリクエストの処理中にエラーが発生しました",
    "入力された文字を下に表示",
    "ロボットではありません",
    "captcha",
)
CONTINUE_PAGE_A = "ショッピングを続けてください"
BLOCKED_WORDS_B = (
    "powered and protected by",
    "access denied",
    "forbidden",
    "captcha",
    "not a robot",
    "通信に問題があるためアクセスを遮断しました。",
    "アクセスが集中",
    "しばらくしてから再度アクセスしてください",
    "不正なアクセス",
    "ご利用の環境",
)
CHALLENGE_TITLE = "Just a moment"
CHALLENGE_BODY = ("Verifying you are human", "needs to review the security", "Sorry, you have been blocked")
BLOCKED_ERRORS = ("captcha", "access denied", "blocked", "403", "429")
TRANSPORT_ERRORS = (
    "err_http2_protocol_error", "net::err_", "tls", "ssl", "certificate", "econnreset", "connection reset",
    "connection refused", "connection closed", "socket hang up", "name not resolved", "internet disconnected",
)
RETRYABLE_ERRORS = (
    "target page, context or browser has been closed",
    "browser has been closed",
    "page has been closed",
    "navigation failed because page was closed",
    "execution context was destroyed",
    "timeout",
    "出力csvが確認できませんでした",
)
TIMEOUT_ERRORS = ("timeout", "timed out", "net::err")
NO_RESULTS_A = ("一致する商品はありません", "検索結果はありません", "結果は見つかりませんでした", "検索に一致する商品はありません")
NO_RESULTS_B = (
    "検索に一致する商品は見つかりませんでした", "該当する商品がありません", "検索結果はありません", "結果は見つかりませんでした",
)
STATUS_A = ("ok", "blocked", "transport_error", "error")
STATUS_B = ("ok", "no_results", "blocked", "transport_error", "error")
STATUS_OFFICIAL = ("ok", "not_found", "blocked", "error")


def _refused(status: Column | str) -> Column:
    return F.coalesce(as_col(status).isin(403, 429), F.lit(False))


def is_blocked(status: Column | str, text: Column | str) -> Column:
    return _refused(status) | contains_any(F.lower(as_col(text)), BLOCKED_WORDS)


def is_blocked_a(status: Column | str, title: Column | str, text: Column | str) -> Column:
    """Search shop A, its continue-shopping page included."""
    both = F.lower(F.concat_ws(" ", as_col(title), as_col(text)))
    return _refused(status) | contains_any(both, BLOCKED_WORDS_A) | contains_any(as_col(text), (CONTINUE_PAGE_A,))


def is_browser_error_page(url: Column | str) -> Column:
    url = F.lower(F.trim(as_col(url)))
    return F.startswith(url, F.lit("chrome-error://")) | F.startswith(url, F.lit("about:neterror"))


def is_blocked_b(url: Column | str, status: Column | str, title: Column | str, text: Column | str) -> Column:
    """Search shop B; a browser error page is judged by its status alone."""
    both = F.lower(F.concat_ws("\n", as_col(title), as_col(text)))
    page = is_blocked(status, text) | contains_any(both, BLOCKED_WORDS_B)
    return F.when(is_browser_error_page(url), _refused(status)).otherwise(page)


def is_challenge(title: Column | str, text: Column | str) -> Column:
    return contains_any(as_col(title), (CHALLENGE_TITLE,)) | contains_any(as_col(text), CHALLENGE_BODY)


def is_blocked_error(c: Column | str) -> Column:
    return contains_any(F.lower(as_col(c)), BLOCKED_ERRORS)


def is_transport_error(c: Column | str) -> Column:
    return contains_any(F.lower(as_col(c)), TRANSPORT_ERRORS)


def is_retryable_error(c: Column | str) -> Column:
    return contains_any(F.lower(as_col(c)), RETRYABLE_ERRORS)


def is_timeout_error(c: Column | str) -> Column:
    return contains_any(F.lower(as_col(c)), TIMEOUT_ERRORS)


def is_closed_error(c: Column | str) -> Column:
    return contains_any(as_col(c), ("Target page, context or browser has been closed",))


def is_crashed_error(c: Column | str) -> Column:
    return contains_any(as_col(c), ("Page crashed",))


def official_status(http_status: Column | str, blocked: Column | str) -> Column:
    code = as_col(http_status)
    return F.when(as_col(blocked), "blocked").when(code == 404, "not_found").when(code >= 400, "error").otherwise("ok")


def search_status_b(no_results: Column | str, items: Column | str) -> Column:
    return F.when(as_col(no_results) | (as_col(items) == 0), "no_results").otherwise("ok")


def failed_status(blocked: Column | str, message: Column | str) -> Column:
    return F.when(as_col(blocked), "blocked").when(is_transport_error(message), "transport_error").otherwise("error")


def has_no_results(text: Column | str, shop: str) -> Column:
    """Empty-result phrases of search shop ``a`` or ``b``."""
    return contains_any(as_col(text), {"a": NO_RESULTS_A, "b": NO_RESULTS_B}[shop])
