"""Small fixtures: purchase rows and files with every difficulty the CSV rules name."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

HEADER = "invoice_number,stock_code,detail,quantity,invoice_date,unit_price,customer_id,country"
GOOD_LINE = "536365,85123A,plain,6,2010-12-01 08:26:00,2.550,17850,United Kingdom"

GOOD_FILE = "\n".join(
    [
        HEADER,
        GOOD_LINE,
        '536366,71053,"say ""hi"", then\nleave",6,2010-12-01 08:26:00.123456,3.390,,France',
        "536367,84406B,back\\slash \\N,-8,2010-12-02 00:00:00,0.001,17850,",
        '536368,"",  blanks  ,0,,,13047,"  "',
        "",
    ]
)
GOOD_ROWS = [
    ("536365", "85123A", "plain", 6, datetime(2010, 12, 1, 8, 26), Decimal("2.550"), 17850,
     "United Kingdom"),
    ("536366", "71053", 'say "hi", then\nleave', 6, datetime(2010, 12, 1, 8, 26, 0, 123456),
     Decimal("3.390"), None, "France"),
    ("536367", "84406B", "back\\slash \\N", -8, datetime(2010, 12, 2), Decimal("0.001"), 17850,
     None),
    ("536368", "", "  blanks  ", 0, None, None, 13047, "  "),
]


def line(**changes: str) -> str:
    fields = dict(zip(HEADER.split(","), GOOD_LINE.split(",")))
    return ",".join({**fields, **changes}.values())


def write(path, *lines: str) -> str:
    path.write_text("\n".join([HEADER, *lines, ""]))
    return str(path)
