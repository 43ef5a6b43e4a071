"""Defaults and fixed values shared by all modules.

Every threshold below is only a default: each operator takes it as a parameter.
"""

# The nine window features, in their published order.
FEATURES = [
    "ear_mean",
    "ear_min",
    "ear_std",
    "perclos",
    "mar_mean",
    "mar_max",
    "head_pitch_mean",
    "head_yaw_mean",
    "head_roll_mean",
]

# Landmark numbers of the face mesh.
RIGHT_EYE = [33, 160, 158, 133, 153, 144]
LEFT_EYE = [362, 385, 387, 263, 373, 380]
MOUTH = [61, 291, 39, 181, 0, 17, 269, 405]
POSE_POINTS = [1, 152, 226, 446, 57, 287]
N_LANDMARKS = 468

# Head model in mm (nose tip, chin, eye corners, mouth corners).
HEAD_MODEL = [
    (0.0, 0.0, 0.0),
    (0.0, -63.6, -12.5),
    (-43.3, 32.7, 26.0),
    (43.3, 32.7, 26.0),
    (-28.9, -28.9, 24.1),
    (28.9, -28.9, 24.1),
]

FRAME_WIDTH = 640
FRAME_HEIGHT = 480

WINDOW = 30
EAR_CLOSED = 0.25
MAR_YAWN = 0.60
PERCLOS_STRONG = 0.80
DECIMATION = 7

CONFIDENCE_ALERT = 0.7
CONFIDENCE_STATE = 0.5
DROWSY_FRAMES = 15
ALERT_FRAMES = 10

DRIFT_BUFFER = 300
DRIFT_MIN_VALUES = 30
DRIFT_LIMIT = 0.15
FEATURE_DRIFT_LIMIT = 0.20
DRIFT_EVERY = 100
VARIANCE_FLOOR = 1e-9
HISTOGRAM_BINS = 20

TEST_SHARE = 0.2
SEED = 42
PROMOTE_GAIN = 0.02

# Acceptance limits for a model.
MIN_F1 = 0.85
MIN_AUC = 0.90
MAX_P95_MS = 200.0

# Upper bounds of the service histograms.
LATENCY_BUCKETS = [0.01, 0.025, 0.05, 0.075, 0.1, 0.15, 0.2, 0.3, 0.5, 1.0]
CONFIDENCE_BUCKETS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
EXTRACTION_BUCKETS = [0.005, 0.01, 0.02, 0.05, 0.1, 0.2]

# Valid range per feature (None = unbounded).
FEATURE_RANGES = {
    "ear_mean": (0.0, 1.0),
    "ear_min": (0.0, 1.0),
    "ear_std": (0.0, None),
    "perclos": (0.0, 1.0),
    "mar_mean": (0.0, None),
    "mar_max": (0.0, None),
    "head_pitch_mean": (None, None),
    "head_yaw_mean": (None, None),
    "head_roll_mean": (None, None),
}

# Alerts that start a retraining run.
TRIGGER_ALERTS = ["DataDriftDetected", "EARFeatureDrift", "PERCLOSFeatureDrift", "HighErrorRate"]
