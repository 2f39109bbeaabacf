"""Fixed values the jobs must share with the reference for equal results.

Fixed values (status codes, page ids, source names, time parameters), stated
as plain text in natural order.
"""

# ---- fixed values: order / coupon / refund status codes ---------------------
ORDER_STATUS_UNPAID = "1001"
ORDER_STATUS_CANCEL = "1003"
ORDER_STATUS_REFUND = "1005"
COUPON_STATUS_UNUSED = "1401"
COUPON_STATUS_USING = "1402"
COUPON_STATUS_USED = "1403"
PAYMENT_STATUS_SUCCESS = "1602"
REFUND_STATUS_SUCCESS = "0702"

# ---- fixed values: page ids and sources ---------------------------------
PAGE_HOME = "home"
PAGE_GOOD_DETAIL = "good_detail"
PAGE_LOGIN = "login"
PAGE_SEARCH = "search"
ITEM_TYPE_KEYWORD = "keyword"
KEYWORD_SOURCE_SEARCH = "SEARCH"

# ---- fixed values: CDC markers ------------------------------------------------
CDC_BOOTSTRAP_TYPES = ("bootstrap-start", "bootstrap-complete")

# ---- fixed values: time parameters (seconds) --------------------------------
WINDOW_SECONDS = 10            # every metric window
JUMP_WITHIN_SECONDS = 10       # bounce detection horizon
JUMP_SHIFT_SECONDS = 10        # bounces are counted 10 s later
LATENESS_SECONDS = 10          # allowed lateness of the traffic metric
WATERMARK_SKU_SECONDS = 5
WATERMARK_KEYWORD_SECONDS = 3
JOIN_TTL_ORDER_SECONDS = 905   # order pre-process, payment
JOIN_TTL_REFUND_SECONDS = 5    # refund, refund payment, comment
BACK_USER_DAYS = 8             # returning-user gap

# Output formats of the window labels.
FMT_DATETIME = "yyyy-MM-dd HH:mm:ss"
FMT_DATE = "yyyy-MM-dd"
FMT_PARTITION = "yyyyMMdd"
