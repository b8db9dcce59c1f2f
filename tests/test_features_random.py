"""compute_features against a plain pandas implementation of the same rules
(SURVEY §2.13 N1-N6) on random frames with NULL, equal and future times; both
the window path and the blocked (hot-key) path."""
import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest

from tidewatch.operators import features as FE

REF = dt.datetime(2024, 6, 15)
VSCHEMA = ("video_id string, channel_id string, published_at timestamp, view_count long, like_count long, "
           "comment_count long, comments_disabled boolean, duration_seconds int")


def expected(ch_ids, vids, short=30, long=90, min_videos=2):
    out = {}
    for cid in ch_ids:
        v = vids[vids.channel_id == cid].copy()
        t = v.published_at
        in_s = (t >= REF - dt.timedelta(days=short)).fillna(False)
        in_l = (t >= REF - dt.timedelta(days=long)).fillna(False)
        n_s, n_l = int(in_s.sum()), int(in_l.sum())
        if n_l == 0:
            out[cid] = dict(f30=None, f90=None, mom=None, eng=None, days=None, reg=None, dur=None, ins=True)
            continue
        days = t.map(lambda x: None if pd.isna(x) else math.floor((REF - x).total_seconds() / 86400))
        vpd = [None if (d is None or pd.isna(vc)) else vc / max(d, 1) for d, vc in zip(days, v.view_count)]
        v["vpd"] = pd.Series(vpd, index=v.index, dtype="float64")

        def avg(s):
            s = s.dropna()
            return float(s.mean()) if len(s) else None
        rec, old = avg(v.vpd[in_s]), avg(v.vpd[in_l & ~in_s])
        mom = None
        if rec is not None and old is not None and old > 0:
            mom = rec / old
        elif len(v) >= 4:
            srt = v.assign(_nt=v.published_at.isna()).sort_values(["_nt", "published_at", "video_id"])
            mid = len(srt) // 2
            o2, r2 = avg(srt.vpd.iloc[:mid]), avg(srt.vpd.iloc[mid:])
            mom = r2 / o2 if (o2 is not None and r2 is not None and o2 > 0) else None
        eng = [None if (vc is None or pd.isna(vc) or vc == 0) else min(max(((lk if not pd.isna(lk) else 0) +
               (cm if not pd.isna(cm) else 0)) / vc, 0), 1) for lk, cm, vc in zip(v.like_count, v.comment_count, v.view_count)]
        last = t.max()
        reg = None
        if len(v) >= 3:
            srt = v.assign(_nt=v.published_at.isna()).sort_values(["_nt", "published_at", "video_id"])
            gaps = [math.floor((b - a).total_seconds() / 86400) for a, b in zip(srt.published_at[:-1], srt.published_at[1:])
                    if not (pd.isna(a) or pd.isna(b))]
            reg = float(np.std(gaps, ddof=1)) if len(gaps) >= 2 else None
        target = v[in_s] if n_s > 0 else v
        dur = avg(target.duration_seconds / 60.0)
        out[cid] = dict(f30=n_s / short, f90=n_l / long, mom=mom, eng=avg(pd.Series(eng, dtype="float64")),
                        days=None if pd.isna(last) else max(math.floor((REF - last).total_seconds() / 86400), 0),
                        reg=reg, dur=dur, ins=(n_s < min_videos and n_l < min_videos))
    return out


def random_videos(seed, n_channels=6, max_videos=30):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n_channels):
        for i in range(int(rng.integers(0, max_videos))):
            r = rng.random()
            if r < 0.05:
                ts = None
            elif r < 0.15:
                ts = REF - dt.timedelta(days=10)                      # equal times
            elif r < 0.2:
                ts = REF + dt.timedelta(hours=int(rng.integers(1, 72)))  # future
            else:
                ts = REF - dt.timedelta(seconds=int(rng.integers(0, 200 * 86400)))
            views = None if rng.random() < 0.05 else int(rng.integers(0, 5000))
            rows.append((f"v{c}_{i:03d}", f"ch{c}", ts, views, int(rng.integers(0, 100)),
                         None if rng.random() < 0.2 else int(rng.integers(0, 20)), False,
                         None if rng.random() < 0.1 else int(rng.integers(1, 3600))))
    return rows


@pytest.mark.parametrize("seed,blocks", [(1, 1), (2, 3), (3, 8), (4, 40)])
def test_features_match_pandas_rules(spark, seed, blocks):
    rows = random_videos(seed)
    ch = spark.createDataFrame([(f"ch{c}",) for c in range(7)], "channel_id string")   # ch6: no videos
    vi = spark.createDataFrame(rows, VSCHEMA)
    got = {r["channel_id"]: r for r in FE.compute_features(ch, vi, REF, blocks=blocks).collect()}
    pdf = pd.DataFrame(rows, columns=["video_id", "channel_id", "published_at", "view_count", "like_count",
                                      "comment_count", "comments_disabled", "duration_seconds"])
    pdf["published_at"] = pd.to_datetime(pdf["published_at"])
    exp = expected([f"ch{c}" for c in range(7)], pdf)
    names = {"f30": "upload_freq_30d", "f90": "upload_freq_90d", "mom": "momentum_ratio", "eng": "avg_engagement_rate",
             "days": "days_since_last_upload", "reg": "upload_regularity", "dur": "duration_trend",
             "ins": "insufficient_history"}
    for cid, e in exp.items():
        for k, col in names.items():
            a, b = got[cid][col], e[k]
            if b is None or (isinstance(b, float) and math.isnan(b)):
                assert a is None, (cid, col, a)
            else:
                assert a == pytest.approx(b, rel=1e-9, abs=1e-12), (cid, col, a, b)
