"""Geometry over the embedding table: 64 numbers as 32 points."""

from __future__ import annotations

from pyspark.sql import functions as F

from wakeframe.constants import HEAD_MODEL
from wakeframe.functions import geometry as G
from wakeframe.functions import scalars as S
from wakeframe.suite.registry import query, table

RIGHT, LEFT, MOUTH = [0, 1, 2, 3, 4, 5], [6, 7, 8, 9, 10, 11], [12, 13, 14, 15, 16, 17, 18, 19]


def wide_points(spark, folder, *keep):
    e = F.col("embedding")
    columns = []
    for i in range(32):
        columns += [
            F.get(e, F.lit(2 * i)).cast("double").alias(f"lm_{i}_x"),
            F.get(e, F.lit(2 * i + 1)).cast("double").alias(f"lm_{i}_y"),
            F.lit(0.0).alias(f"lm_{i}_z"),
        ]
    return table(spark, folder, "embeddings").select("vec_id", "label", *keep, *columns)


def points(spark, folder, *keep):
    return G.pack_landmarks(wide_points(spark, folder, *keep), 32)


def px(i: int) -> str:
    return f"(embedding[{2 * i + 1}]::DOUBLE * 640)"


def py(i: int) -> str:
    return f"(embedding[{2 * i + 2}]::DOUBLE * 480)"


def dist(i: int, j: int) -> str:
    return f"sqrt(({px(i)} - {px(j)}) * ({px(i)} - {px(j)}) + ({py(i)} - {py(j)}) * ({py(i)} - {py(j)}))"


def eye(at) -> str:
    return f"(({dist(at[1], at[5])} + {dist(at[2], at[4])}) / (2 * {dist(at[0], at[3])}))"


@query(
    "eye_and_mouth_ratios",
    f"""
    SELECT vec_id, round(({eye(RIGHT)} + {eye(LEFT)}) / 2, 6) AS ear,
           round({dist(MOUTH[4], MOUTH[5])} / {dist(MOUTH[0], MOUTH[1])}, 6) AS mar,
           CASE WHEN ({eye(RIGHT)} + {eye(LEFT)}) / 2 < 0.25 THEN 1 ELSE 0 END AS closed
    FROM embeddings
    """,
)
def eye_and_mouth_ratios(spark, folder):
    lm = F.col("landmarks")
    ear = G.both_eyes_ratio(lm, RIGHT, LEFT)
    return points(spark, folder).select(
        "vec_id",
        F.round(ear, 6).alias("ear"),
        F.round(G.mouth_ratio(lm, MOUTH), 6).alias("mar"),
        S.eye_closed(ear).alias("closed"),
    )


@query(
    "packed_landmarks",
    f"""
    SELECT vec_id, 20 AS n, round({' + '.join(px(i) for i in range(20))}, 4) AS x,
           round({' + '.join(py(i) for i in range(20))}, 4) AS y
    FROM embeddings
    """,
)
def packed_landmarks(spark, folder):
    """Wide columns packed, cut to the mesh, scaled to pixels, summed."""
    pixels = G.to_pixels(G.keep_mesh(F.col("landmarks"), 20))

    def total(axis):
        return F.round(F.aggregate(F.col("p"), F.lit(0.0), lambda a, p: a + p[axis]), 4)

    return points(spark, folder).select("vec_id", pixels.alias("p")).select(
        "vec_id", F.size("p").alias("n"), total("x").alias("x"), total("y").alias("y")
    )


ANGLES = ("pitch", "yaw", "roll")


def posed_points(df, jitter: float = 0.0):
    """The head model turned by angles out of ``embedding`` and projected; ``jitter`` moves points by embedding * jitter pixels."""
    e = F.col("embedding")
    df = df.withColumns({a: F.round(F.get(e, F.lit(i)).cast("double") * 90, 2) for i, a in enumerate(ANGLES)})
    sin = {a: F.sin(F.radians(a)) for a in ANGLES}
    cos = {a: F.cos(F.radians(a)) for a in ANGLES}
    r = [
        [
            cos["roll"] * cos["yaw"],
            cos["roll"] * sin["yaw"] * sin["pitch"] - sin["roll"] * cos["pitch"],
            cos["roll"] * sin["yaw"] * cos["pitch"] + sin["roll"] * sin["pitch"],
        ],
        [
            sin["roll"] * cos["yaw"],
            sin["roll"] * sin["yaw"] * sin["pitch"] + cos["roll"] * cos["pitch"],
            sin["roll"] * sin["yaw"] * cos["pitch"] - cos["roll"] * sin["pitch"],
        ],
        [-sin["yaw"], cos["yaw"] * sin["pitch"], cos["yaw"] * cos["pitch"]],
    ]
    shift = (12.0, -7.0, 900.0)
    out = []
    for i, p in enumerate(HEAD_MODEL):
        x, y, z = (sum(r[row][c] * p[c] for c in range(3)) + shift[row] for row in range(3))
        off = [F.get(e, F.lit(20 + 2 * i + k)).cast("double") * jitter if jitter else F.lit(0.0) for k in (0, 1)]
        out.append(
            F.struct(
                ((640 * x / z + 320 + off[0]) / 640).alias("x"),
                ((640 * y / z + 240 + off[1]) / 480).alias("y"),
                F.lit(0.0).alias("z"),
            )
        )
    return df.withColumn("posed", F.array(*out))


ANGLE_SQL = ", ".join(f"round(embedding[{i + 1}]::DOUBLE * 90, 2) AS {a}" for i, a in enumerate(ANGLES))


@query("head_pose", f"SELECT vec_id, {ANGLE_SQL} FROM embeddings")
def head_pose(spark, folder):
    """Angles are recovered from projected points of a known rotation."""
    df = posed_points(table(spark, folder, "embeddings"))
    solved = df.select("vec_id", G.head_pose(F.col("posed"), range(6), places=6).alias("pose"))
    return solved.select("vec_id", *[(F.round(f"pose.{a}", 2) + 0.0).alias(a) for a in ANGLES])


@query(
    "noisy_head_pose",
    f"""
    WITH n AS (SELECT vec_id, sqrt(({' + '.join(f'pow(embedding[{21 + k}]::DOUBLE * 5, 2)' for k in range(12))}) / 6) AS noise
      FROM embeddings)
    SELECT vec_id, round(noise, 6) AS noise_px, true AS fits_better_than_truth, noise < 2 AS small_noise FROM n
    """,
)
def noisy_head_pose(spark, folder):
    """Points moved by some pixels: the fitted pose leaves no more error than the true one."""
    e = F.col("embedding")
    df = posed_points(table(spark, folder, "embeddings"), jitter=5.0)
    square = sum((F.pow(F.get(e, F.lit(20 + k)).cast("double") * 5, F.lit(2.0)) for k in range(12)), F.lit(0.0))
    solved = df.select("vec_id", F.sqrt(square / 6).alias("noise"), G.head_pose(F.col("posed"), range(6)).alias("pose"))
    return solved.select(
        "vec_id",
        F.round("noise", 6).alias("noise_px"),
        (F.col("pose.error") <= F.col("noise") + 1e-9).alias("fits_better_than_truth"),
        (F.col("noise") < 2).alias("small_noise"),
    )


@query(
    "frame_features",
    f"""
    SELECT round(({eye(RIGHT)} + {eye(LEFT)}) / 2, 6) AS ear, round({dist(MOUTH[4], MOUTH[5])} / {dist(MOUTH[0], MOUTH[1])}, 6)
      AS mar, {ANGLE_SQL.replace('AS pitch', 'AS head_pitch').replace('AS yaw', 'AS head_yaw').replace('AS roll', 'AS head_roll')},
      (label % 2)::INT AS label, coalesce(label::VARCHAR, 'unknown') AS subject_id, vec_id AS frame_id
    FROM embeddings
    """,
)
def frame_features(spark, folder):
    """All per-frame features: eyes and mouth from the stand-in points, the head from a posed model."""
    df = posed_points(points(spark, folder, "embedding")).withColumns(
        {
            "landmarks": F.concat(F.slice("landmarks", 1, 20), "posed"),
            "subject_id": F.col("label").cast("string"),
            "frame_id": F.col("vec_id"),
            "label": F.col("label") % 2,
        }
    )
    return G.frame_features(df, right=RIGHT, left=LEFT, mouth=MOUTH, pose=range(20, 26))


@query(
    "euler_angles",
    """
    WITH a AS (SELECT vec_id, embedding[1]::DOUBLE AS c, embedding[2]::DOUBLE AS d, embedding[3]::DOUBLE AS e,
      embedding[4]::DOUBLE AS f, embedding[5]::DOUBLE AS g FROM embeddings)
    SELECT vec_id, round(degrees(atan2(f, g)), 4) AS pitch, round(degrees(atan2(-e, sqrt(c * c + d * d))), 4) AS yaw,
           round(degrees(atan2(d, c)), 4) AS roll FROM a
    """,
)
def euler_angles(spark, folder):
    """Angle decomposition of matrix entries taken from the embedding."""
    e = F.col("embedding")
    at = {"r00": 0, "r10": 1, "r20": 2, "r21": 3, "r22": 4, "r11": 5, "r12": 6}
    entries = {k: F.get(e, F.lit(i)).cast("double") for k, i in at.items()}
    return table(spark, folder, "embeddings").select("vec_id", G.euler_angles(entries).alias("a")).select(
        "vec_id", "a.*"
    )
