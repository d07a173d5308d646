"""Similarity: top-k on an own design base against numpy, properties."""
from gridtel.operators import similarity

# An own design base of twelve units: (power, HV, LV, impedance, year, no-load, load loss, mass, length, width, height).
BASE = [(10.25, 69.0, 13.8, 7.0, 1999, 11.2, 60.4, 20.11, 4.2, 2.1, 3.0), (12.5, 69.0, 13.8, 7.5, 2001, 12.9, 66.0, 22.35, 4.4, 2.2, 3.1),
        (25.0, 138.0, 13.8, 9.0, 2005, 20.15, 110.0, 38.0, 5.6, 2.6, 3.7), (26.75, 138.0, 13.8, 9.2, 2006, 21.0, 116.3, 39.9, 5.7, 2.7, 3.7),
        (40.0, 138.0, 34.5, 10.0, 2010, 28.0, 160.0, 55.5, 6.3, 3.0, 4.1), (60.0, 230.0, 69.0, 11.5, 2012, 39.4, 230.0, 84.0, 7.4, 3.3, 4.6),
        (62.5, 230.0, 69.0, 11.0, 2013, 40.1, 236.2, 86.1, 7.5, 3.3, 4.6), (100.0, 230.0, 69.0, 12.5, 2015, 61.0, 350.0, 125.0, 8.8, 3.8, 5.2),
        (150.0, 345.0, 138.0, 13.0, 2016, 85.0, 480.0, 171.0, 9.9, 4.1, 5.8), (200.0, 345.0, 138.0, 14.0, 2018, 110.0, 610.0, 220.0, 10.9, 4.4, 6.2),
        (300.0, 500.0, 230.0, 15.0, 2020, 150.0, 850.0, 300.0, 12.2, 4.9, 6.9), (10.25, 69.0, 13.8, 7.0, 1999, 11.2, 60.4, 20.11, 4.2, 2.1, 3.0)]
COLUMNS = ("rated_power_mva", "hv_voltage_kv", "lv_voltage_kv", "impedance_percent", "commissioning_year", "no_load_loss_kw",
           "load_loss_kw", "total_mass_t", "length_m", "width_m", "height_m")
FIXED = {"frequency_hz": 60.0, "phase_count": 3.0}


def base(spark):
    rows = [dict(zip(COLUMNS, map(float, r))) | {"transformer_id": f"TR-{i + 1:03d}"} | FIXED for i, r in enumerate(BASE)]
    return spark.createDataFrame(rows)


def expected(target):
    import numpy as np

    from gridtel.params import DESIGN_FEATURES
    x = np.array([[FIXED.get(f) or r[COLUMNS.index(f)] for f in DESIGN_FEATURES] for r in BASE], float)
    others = [i for i in range(len(BASE)) if i != target]
    mean, std = x[others].mean(axis=0), x[others].std(axis=0)
    std[std == 0] = 1
    d = np.sqrt((((x[others] - mean) / std - (x[target] - mean) / std) ** 2).sum(axis=1))
    return sorted(((f"TR-{i + 1:03d}", round(float(1 / (1 + v)), 4)) for i, v in zip(others, d)), key=lambda r: (-r[1], r[0]))


def test_top5_against_numpy(spark):
    for target in (1, 4, 8):
        got = [(r.transformer_id, r.score) for r in similarity.similar_one(base(spark), f"TR-{target + 1:03d}", 5).collect()]
        assert got == expected(target)[:5]


def test_self_match_and_order(spark):
    res = similarity.similar_one(base(spark), "TR-001", None).collect()
    assert res[0].transformer_id == "TR-012" and res[0].score >= 0.99
    scores = [r.score for r in res]
    assert all(0 < s <= 1 for s in scores) and scores == sorted(scores, reverse=True)
    assert len(res) == len(BASE) - 1
