"""Schemas and domain constants."""

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Aspect order: head i of a model is aspect i.
ASPECTS = ["Price", "Shipping", "Outlook", "Quality", "Size", "Shop_Service", "General", "Others"]
# Label index -> name (stored labels are raw labels + 1): 0 NONE, 1 NEG, 2 POS, 3 NEU.
LABEL_NAMES = ["NONE", "NEG", "POS", "NEU"]
DEFAULT_LABEL = "NONE"
# Sentiments shown on the dashboard, in display order.
DASHBOARD_SENTIMENTS = ["POS", "NEU", "NEG"]
# Detector class ids kept, and their names: 2 car, 3 motorcycle, 5 bus, 7 truck.
VEHICLE_CLASSES = {2: "car", 3: "motorcycle", 5: "bus", 7: "truck"}
VEHICLE_NAMES = ["car", "motorcycle", "bus", "truck"]
UNKNOWN_VEHICLE = "unknown"
# Vocabulary: 0 is padding, 1 unknown, words from 2; at most 6000 words kept.
PAD_TOKEN, PAD_ID = "<PAD>", 0
UNK_TOKEN, UNK_ID = "<UNK>", 1
MAX_VOCAB = 6000
BATCH_SIZE = 64
NUM_CLASSES = 4
TARGET_WIDTH = 640
MAX_MESSAGE_BYTES = 10485760
DEFAULT_MODEL_NAME = "cnn_best.pth"
MODEL_NAME_FORMAT = "cnn_v%d.pth"
# ---------------------------------------------------------------------------
# Fixed values too: names and types of message, result and registry fields,
# which other programs read and write.

REVIEW_MESSAGE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("review", T.StringType()),
])

FRAME_MESSAGE = T.StructType([
    T.StructField("frame_id", T.IntegerType()),
    T.StructField("video_second", T.IntegerType()),
    T.StructField("image_b64", T.StringType()),
    T.StructField("source_video", T.StringType()),
])

INFERENCE_RESULT = T.StructType([
    T.StructField("total_count", T.IntegerType()),
    T.StructField("class_counts", T.StringType()),
    T.StructField("boxes_json", T.StringType()),
    T.StructField("annotated_b64", T.StringType()),
])

BOX = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("conf", T.DoubleType()),
    T.StructField("xyxy", T.ArrayType(T.DoubleType())),
])

DETECTIONS = T.StructType([
    T.StructField("source_video", T.StringType()),
    T.StructField("frame_id", T.IntegerType()),
    T.StructField("boxes", T.ArrayType(BOX)),
])

FRAME_RESULT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("frame_id", T.IntegerType()),
    T.StructField("video_second", T.IntegerType()),
    T.StructField("total_count", T.IntegerType()),
    T.StructField("class_counts", T.StringType()),
    T.StructField("image_path", T.StringType()),
    T.StructField("annotation_json", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

REGISTRY = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("model_name", T.StringType(), False),
    T.StructField("macro_f1", T.DoubleType(), False),
    T.StructField("balanced_acc", T.DoubleType(), False),
    T.StructField("created_at", T.TimestampType()),
])

VOCABULARY = T.StructType([
    T.StructField("token", T.StringType(), False),
    T.StructField("id", T.IntegerType(), False),
])

LOSS_HISTORY = T.StructType([
    T.StructField("run", T.StringType()),
    T.StructField("epoch", T.IntegerType()),
    T.StructField("val_loss", T.DoubleType()),
])


def labelled_reviews_schema(text_col: str = "Review") -> T.StructType:
    """Header CSV of labelled reviews: text + 8 integer labels in -1..2."""
    return T.StructType([T.StructField(text_col, T.StringType())]
                        + [T.StructField(a, T.IntegerType()) for a in ASPECTS])


def scored_reviews_schema() -> T.StructType:
    return T.StructType([T.StructField("ReviewText", T.StringType())]
                        + [T.StructField(a, T.StringType()) for a in ASPECTS])
