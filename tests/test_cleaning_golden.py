"""Raw monthly sheet -> long facts, checked against the committed cleaned file
(Paid Search rows: 5 years x 12 months = 60 rows, zeros kept, TOTAL dropped)."""

import datetime as dt
import os
import tempfile

from roaskit.operators.reshape import unpivot_months
from roaskit.sources.files import normalize_columns, read_messy_csv, rename_columns

# The sheet's own rows.
RAW = (
    "﻿CHANNEL,YEAR,JANUARY,FEBRUARY,MARCH,APRIL,MAY,JUNE,JULY,AUGUST,SEPTEMBER,OCTOBER,NOVEMBER,DECEMBER,TOTAL\n"
    'Paid Search,2025,"1,405","1,169","1,433","1,322",0,0,0,0,0,0,0,0,"5,329"\n'
    'Paid Search,2024,"1,380","1,085",955,"1,162","1,399",933,"1,011","1,308","1,307","1,224","1,969","2,688","16,421"\n'
    'Paid Search,2023,"1,206",828,325,477,"1,393",950,"1,261","1,174","1,494",908,"3,334","2,403","15,753"\n'
    'Paid Search,2022,828,813,915,676,937,801,827,845,"1,168",793,"2,686","1,881","13,170"\n'
    'Paid Search,2021,686,600,540,454,"1,054",668,739,693,657,593,"1,516","1,062","9,262"\n'
)
# Spot values of the cleaned file.
CLEANED = {"2023-03-01": 325.0, "2025-05-01": 0.0, "2022-09-01": 1168.0, "2021-11-01": 1516.0,
           "2024-12-01": 2688.0, "2024-01-01": 1380.0, "2025-01-01": 1405.0}


def test_raw_sheet_to_cleaned_long(spark):
    p = os.path.join(tempfile.mkdtemp(prefix="roaskit-raw-"), "cust_new.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write(RAW)
    df = rename_columns(normalize_columns(read_messy_csv(spark, p)), {"channel": "channel_name"})
    assert df.columns[0] == "channel_name" and "total" in df.columns
    long = unpivot_months(df, ["channel_name", "year"])
    rows = {(r.date.isoformat()): r.value for r in long.collect()}
    assert len(rows) == 60
    for d, v in CLEANED.items():
        assert rows[d] == v
    by_year = {}
    for d, v in rows.items():
        by_year[d[:4]] = by_year.get(d[:4], 0.0) + v
    # the sheet's TOTAL column agrees with the unpivoted months
    assert by_year == {"2025": 5329.0, "2024": 16421.0, "2023": 15753.0, "2022": 13170.0, "2021": 9262.0}
    assert min(dt.date.fromisoformat(d) for d in rows) == dt.date(2021, 1, 1)
