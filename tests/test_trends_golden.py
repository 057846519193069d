"""Golden monthly ROAS and CAC for paid search and paid social (the published
rows without imputation, 2023-11 .. 2025-05): inputs are the cleaned media,
net-sales and new-customer values of each month."""

import datetime as dt

from roaskit.plans import channels as ch

# date, channel, media spend, agency fee, net sales, new customers, ROAS, CAC (published, 6 places)
GOLDEN = [
    ("2023-11-01", "Paid Search", 96006.0, 0.0, 178000.0, 3334.0, 1.854051, 28.796041),
    ("2023-12-01", "Paid Search", 89836.0, 0.0, 112000.0, 2403.0, 1.246716, 37.384935),
    ("2024-01-01", "Paid Search", 33131.0, 5045.0, 94000.0, 1380.0, 2.46228, 27.663768),
    ("2024-02-01", "Paid Search", 31642.0, 4044.0, 68000.0, 1085.0, 1.905509, 32.890323),
    ("2024-03-01", "Paid Search", 31725.0, 4771.0, 65000.0, 955.0, 1.781017, 38.215707),
    ("2024-04-01", "Paid Search", 32934.0, 4798.0, 79000.0, 1162.0, 2.093714, 32.471601),
    ("2024-05-01", "Paid Search", 48252.0, 5400.0, 96000.0, 1399.0, 1.789309, 38.35025),
    ("2024-06-01", "Paid Search", 41935.0, 6158.0, 62000.0, 933.0, 1.289169, 51.546624),
    ("2024-07-01", "Paid Search", 56408.0, 7051.0, 61000.0, 1011.0, 0.961251, 62.768546),
    ("2024-08-01", "Paid Search", 65506.0, 6862.0, 83000.0, 1308.0, 1.146916, 55.327217),
    ("2024-09-01", "Paid Search", 51646.0, 5384.0, 74000.0, 1307.0, 1.297563, 43.634277),
    ("2024-10-01", "Paid Search", 68150.0, 6959.0, 74000.0, 1224.0, 0.985235, 61.363562),
    ("2024-11-01", "Paid Search", 88112.0, 8336.0, 135000.0, 1969.0, 1.399718, 48.98324),
    ("2024-12-01", "Paid Search", 92682.0, 8623.0, 150000.0, 2688.0, 1.480677, 37.687872),
    ("2025-01-01", "Paid Search", 52392.0, 6063.0, 90000.0, 1405.0, 1.539646, 41.604982),
    ("2025-02-01", "Paid Search", 53764.0, 6874.0, 71000.0, 1169.0, 1.170883, 51.871685),
    ("2025-03-01", "Paid Search", 76624.0, 8192.0, 90000.0, 1433.0, 1.061121, 59.187718),
    ("2025-04-01", "Paid Search", 80616.0, 8339.0, 94000.0, 1322.0, 1.056714, 67.2882),
    ("2025-05-01", "Paid Search", 79749.0, 7501.0, 98000.0, 0.0, 1.123209, 0.0),
    ("2023-11-01", "Paid Social", 215073.0, 0.0, 66000.0, 1561.0, 0.306873, 137.778988),
    ("2023-12-01", "Paid Social", 166116.0, 0.0, 50000.0, 1132.0, 0.300994, 146.745583),
    ("2024-01-01", "Paid Social", 55172.0, 8400.0, 17000.0, 447.0, 0.267413, 142.219239),
    ("2024-02-01", "Paid Social", 99304.0, 12690.0, 14000.0, 324.0, 0.125007, 345.660494),
    ("2024-03-01", "Paid Social", 79542.0, 11963.0, 15000.0, 294.0, 0.163925, 311.241497),
    ("2024-04-01", "Paid Social", 95402.0, 13897.0, 21000.0, 379.0, 0.192134, 288.387863),
    ("2024-05-01", "Paid Social", 203679.0, 22795.0, 55000.0, 1141.0, 0.242853, 198.487292),
    ("2024-06-01", "Paid Social", 85372.0, 12537.0, 28000.0, 523.0, 0.28598, 187.206501),
    ("2024-07-01", "Paid Social", 97484.0, 12185.0, 26000.0, 434.0, 0.237077, 252.693548),
    ("2024-08-01", "Paid Social", 112965.0, 11833.0, 48000.0, 699.0, 0.384622, 178.537911),
    ("2024-09-01", "Paid Social", 134002.0, 13971.0, 33000.0, 665.0, 0.223014, 222.515789),
    ("2024-10-01", "Paid Social", 130267.0, 13303.0, 24000.0, 372.0, 0.167166, 385.94086),
    ("2024-11-01", "Paid Social", 209903.0, 19859.0, 62000.0, 1081.0, 0.269844, 212.545791),
    ("2024-12-01", "Paid Social", 267692.0, 24904.0, 81000.0, 1457.0, 0.276832, 200.820865),
    ("2025-01-01", "Paid Social", 110665.0, 12807.0, 28000.0, 534.0, 0.226772, 231.220974),
    ("2025-02-01", "Paid Social", 93826.0, 11996.0, 21000.0, 380.0, 0.198446, 278.478947),
    ("2025-03-01", "Paid Social", 153218.0, 16380.0, 37000.0, 836.0, 0.218163, 202.868421),
    ("2025-04-01", "Paid Social", 151295.0, 15651.0, 37000.0, 634.0, 0.221629, 263.321767),
    ("2025-05-01", "Paid Social", 238355.0, 22418.0, 42000.0, 0.0, 0.16106, 0.0),
]


def test_monthly_trends_goldens(spark):
    d = [(dt.date.fromisoformat(r[0]),) + r[1:] for r in GOLDEN]
    spend = spark.createDataFrame([(f"{c} Media", m, day) for day, c, m, *_ in d]
                                  + [(f"{c} Agency", a, day) for day, c, _, a, *_ in d],
                                  "channel_name string, value double, date date")
    top = spark.createDataFrame([(day, "shop", f"NET SALES - {c}", n) for day, c, _, _, n, *_ in d]
                                + [(day, "shop", "NET SALES", 1.0) for day, *_ in d],
                                "date date, source string, metric string, value double")
    cust = spark.createDataFrame([(c, k, day) for day, c, _, _, _, k, *_ in d],
                                 "channel_name string, value double, date date")
    t = ch.monthly_trends(ch.monthly_spend(spend), top, cust)
    got = {(r.date, r.mapping_key): r for r in t.collect()}
    assert len(got) == len(GOLDEN)
    for day, c, m, a, n, k, roas, cac in d:
        r = got[(day, c.lower())]
        assert r.total_spend == m + a and r.net_revenue == n
        assert round(r.monthly_roas, 6) == roas and round(r.monthly_cac, 6) == cac
        assert not r.imputed_revenue and not r.imputed_customers
