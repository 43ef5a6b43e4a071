"""Hand-made faces and rotations."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeframe.constants import HEAD_MODEL, LEFT_EYE, MOUTH, N_LANDMARKS, POSE_POINTS, RIGHT_EYE
from wakeframe.functions import geometry as G
from wakeframe.functions import parsing as P
from wakeframe.schemas import LANDMARKS


def eye_points(e, width=0.1):
    h = e * 0.1
    return [(0.3, 0.5), (0.3 + width / 3, 0.5 - h), (0.3 + 2 * width / 3, 0.5 - h), (0.3 + width, 0.5),
            (0.3 + 2 * width / 3, 0.5 + h), (0.3 + width / 3, 0.5 + h)]


def face(e=0.3, width=0.1, m=0.4, n=N_LANDMARKS, pose=None):
    pts = [[0.5, 0.5, 0.0] for _ in range(n)]
    for at in (RIGHT_EYE, LEFT_EYE):
        for i, (x, y) in zip(at, eye_points(e, width)):
            pts[i] = [x, y, 0.0]
    corners = {MOUTH[0]: (0.44, 0.7), MOUTH[1]: (0.56, 0.7), MOUTH[4]: (0.5, 0.7 - m * 0.06), MOUTH[5]: (0.5, 0.7 + m * 0.06)}
    for i, (x, y) in corners.items():
        pts[i] = [x, y, 0.0]
    for i, (x, y) in zip(POSE_POINTS, pose or []):
        pts[i] = [x, y, 0.0]
    return [tuple(p) for p in pts]


def frame(spark, *faces):
    return spark.createDataFrame([("s", i, 0, f) for i, f in enumerate(faces)], LANDMARKS)


def rotated(pitch, yaw, roll, shift=(12.0, -7.0, 900.0)):
    a, b, c = map(math.radians, (pitch, yaw, roll))
    rx = np.array([[1, 0, 0], [0, math.cos(a), -math.sin(a)], [0, math.sin(a), math.cos(a)]])
    ry = np.array([[math.cos(b), 0, math.sin(b)], [0, 1, 0], [-math.sin(b), 0, math.cos(b)]])
    rz = np.array([[math.cos(c), -math.sin(c), 0], [math.sin(c), math.cos(c), 0], [0, 0, 1]])
    cam = np.array(HEAD_MODEL) @ (rz @ ry @ rx).T + shift
    return [(float((640 * x / z + 320) / 640), float((640 * y / z + 240) / 480)) for x, y, z in cam]


@pytest.mark.parametrize("e", [0.12, 0.25, 0.30])
def test_eye_ratio_is_one_and_a_half_times_the_target(spark, e):
    got = frame(spark, face(e)).select(G.both_eyes_ratio(F.col("landmarks")).alias("r")).first()["r"]
    assert got == pytest.approx(1.5 * e, abs=1e-9)


def test_collapsed_eye_and_mouth_are_zero(spark):
    flat = face(0.3, width=0.0)
    flat[MOUTH[1]] = flat[MOUTH[0]]
    row = frame(spark, flat).select(
        G.both_eyes_ratio(F.col("landmarks")).alias("e"), G.mouth_ratio(F.col("landmarks")).alias("m")
    ).first()
    assert (row["e"], row["m"]) == (0.0, 0.0)


def test_mouth_ratio_follows_its_formula(spark):
    pts = face()
    width, opening = 0.12, 0.8 * 0.12
    pts[MOUTH[0]], pts[MOUTH[1]] = (0.44, 0.7, 0.0), (0.56, 0.7, 0.0)
    pts[MOUTH[4]], pts[MOUTH[5]] = (0.5, 0.7 - opening / 2, 0.0), (0.5, 0.7 + opening / 2, 0.0)
    got = frame(spark, pts).select(G.mouth_ratio(F.col("landmarks")).alias("m")).first()["m"]
    assert got == pytest.approx(opening * 480 / (width * 640), abs=1e-9)
    few = frame(spark, pts).select(G.mouth_ratio(F.col("landmarks"), MOUTH[:7]).alias("m")).first()["m"]
    assert few == 0.0


@pytest.mark.parametrize("angles", [(0, 0, 0), (10, -20, 5), (-35, 25, 40), (170, 8, -12), (-160, -30, 20)])
def test_pose_recovers_a_known_rotation(spark, angles):
    pose = G.head_pose(F.col("landmarks"))
    got = frame(spark, face(pose=rotated(*angles))).select(pose.alias("p")).first()["p"]
    assert got["pitch"] == pytest.approx(angles[0], abs=0.01)
    assert got["yaw"] == pytest.approx(angles[1], abs=0.01)
    assert got["roll"] == pytest.approx(angles[2], abs=0.01)


def test_upright_head_has_pitch_180(spark):
    got = frame(spark, face(pose=rotated(180, 0, 0, (0, 0, 900)))).select(G.head_pose(F.col("landmarks")).alias("p"))
    p = got.first()["p"]
    assert abs(p["pitch"]) == pytest.approx(180, abs=0.01)
    assert p["yaw"] == pytest.approx(0, abs=0.01) and p["roll"] == pytest.approx(0, abs=0.01)


def test_pose_is_zero_without_points(spark):
    same = [(0.5, 0.5, 0.0)] * N_LANDMARKS
    rows = frame(spark, [], same[:100], same, None).select("frame_id", G.head_pose(F.col("landmarks")).alias("p"))
    assert all(tuple(r["p"]) == (0.0, 0.0, 0.0, None) for r in rows.collect())


def test_pose_of_noisy_points_is_a_minimum():
    """No pose near the fitted one, and not the true one, leaves less error."""
    from wakeframe.functions import pose

    rng = np.random.default_rng(7)
    model = np.array(HEAD_MODEL)
    angles = rng.uniform(-40, 40, (200, 3))
    exact = np.array([rotated(180 + a, b, c) for a, b, c in angles])
    seen = np.stack([exact[:, :, 0] - 0.5, (exact[:, :, 1] * 480 - 240) / 640], axis=2)
    noise = rng.normal(size=seen.shape) * 2 / 640
    r, t, error = pose.fitted(seen + noise, model)
    assert (error <= np.sqrt((noise**2).sum(axis=(1, 2)) / 6) + 1e-12).all()
    for _ in range(20):
        turn = pose._turn(rng.normal(size=(200, 3)) * 1e-3) @ r
        _, placed = pose.projected(turn, t + rng.normal(size=t.shape) * 1e-2, model)
        gap = placed[:, :, :2] / placed[:, :, 2:] - seen - noise
        assert (np.sqrt((gap**2).sum(axis=(1, 2)) / 6) >= error - 1e-12).all()
    assert np.allclose(r @ r.transpose(0, 2, 1), np.eye(3)) and np.allclose(np.linalg.det(r), 1)


def test_pose_does_not_depend_on_the_batch():
    from wakeframe.functions import pose

    rng = np.random.default_rng(8)
    model, seen = np.array(HEAD_MODEL), rng.uniform(-0.4, 0.4, (60, 6, 2))
    seen[5], seen[6] = 0.1, np.nan
    together = pose.angles_of(pose.fitted(np.nan_to_num(seen), model)[0])
    alone = np.concatenate([pose.angles_of(pose.fitted(np.nan_to_num(seen[i : i + 1]), model)[0]) for i in range(60)])
    assert np.allclose(together, alone, atol=1e-6, equal_nan=True)


def test_frames_with_odd_points_get_rows(spark):
    good = face(0.3, pose=rotated(175, 5, 3))
    odd = [list(p) for p in good]
    odd[POSE_POINTS[2]][0] = float("nan")
    rows = G.frame_features(frame(spark, good, [tuple(p) for p in odd], good)).orderBy("frame_id").collect()
    assert rows[0]["head_yaw"] == pytest.approx(5, abs=0.01) and rows[0]["head_pitch"] == rows[2]["head_pitch"]
    assert (rows[1]["head_pitch"], rows[1]["head_yaw"], rows[1]["head_roll"]) == (0.0, 0.0, 0.0)
    assert rows[1]["ear"] == rows[0]["ear"]


def test_singular_rotation_has_no_roll(spark):
    # yaw of 90 degrees: r00 = r10 = 0
    entries = dict(r00=0.0, r10=0.0, r20=-1.0, r21=0.0, r22=0.0, r11=0.5, r12=-0.25)
    row = spark.range(1).select(G.euler_angles({k: F.lit(v) for k, v in entries.items()}).alias("a")).first()["a"]
    assert row["roll"] == 0.0 and row["yaw"] == 90.0
    assert row["pitch"] == pytest.approx(math.degrees(math.atan2(0.25, 0.5)), abs=1e-4)


def test_frame_row_defaults_and_rounding(spark):
    df = spark.createDataFrame([(face(0.3333333),)], "landmarks array<struct<x double, y double, z double>>")
    row = G.frame_features(df).first()
    assert (row["label"], row["subject_id"], row["frame_id"]) == (0, "unknown", 0)
    assert row["ear"] == 0.5


def test_refined_mesh_and_wide_columns(spark):
    wide = spark.range(1).select(
        F.lit("p").alias("frame_path"),
        *[F.lit(float(i)).alias(f"lm_{i}_{a}") for i in range(10) for a in "xyz"],
    )
    packed = G.pack_landmarks(wide, 10).select(G.keep_mesh(F.col("landmarks"), 8).alias("m"), "frame_path").first()
    assert len(packed["m"]) == 8 and packed["m"][7]["z"] == 7.0


@pytest.mark.parametrize(
    "name, label, subject, number",
    [
        ("drowsy_v1_f000042.jpg", "drowsy", "v1", 42),
        ("v1_drowsy_x_f7.jpg", "drowsy", "v1_x", 7),
        ("drowsy_drowsy_a_f000001.jpg", "drowsy", "drowsy_a", 1),
        ("odd.png", "alert", "odd", 0),
        ("alert_.jpg", "alert", "unknown", 0),
        ("alert_a.b_f3.jpg", "alert", "a.b", 3),
    ],
)
def test_names(spark, name, label, subject, number):
    row = spark.createDataFrame([(name, label)], "n string, l string").select(
        P.subject_name(F.col("n"), F.col("l")).alias("s"), P.frame_number(F.col("n")).alias("f")
    ).first()
    assert (row["s"], row["f"]) == (subject, number)


@pytest.mark.parametrize("source, target, step", [(30, 15, 2), (25, 10, 2), (35, 10, 4), (10, 30, 1), (29.97, 2, 15)])
def test_sampling_step_rounds_half_to_even(spark, source, target, step):
    row = spark.range(1).select(P.sampling_step(F.lit(float(source)), float(target)).alias("s")).first()
    assert row["s"] == step == max(1, round(source / target))
