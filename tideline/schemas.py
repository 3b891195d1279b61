"""Column names, types and roles of the rental-listing data set."""

from pyspark.sql import types as T

# --- fixed values: the listing schema --------------------------------------------------------------
LISTING_SCHEMA = T.StructType(
    [
        T.StructField("host_is_superhost", T.StringType()),
        T.StructField("cancellation_policy", T.StringType()),
        T.StructField("instant_bookable", T.StringType()),
        T.StructField("host_total_listings_count", T.DoubleType()),
        T.StructField("neighbourhood_cleansed", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("property_type", T.StringType()),
        T.StructField("room_type", T.StringType()),
        T.StructField("accommodates", T.DoubleType()),
        T.StructField("bathrooms", T.DoubleType()),
        T.StructField("bedrooms", T.DoubleType()),
        T.StructField("beds", T.DoubleType()),
        T.StructField("bed_type", T.StringType()),
        T.StructField("minimum_nights", T.LongType()),
        T.StructField("number_of_reviews", T.LongType()),
        T.StructField("review_scores_rating", T.DoubleType()),
        T.StructField("review_scores_accuracy", T.DoubleType()),
        T.StructField("review_scores_cleanliness", T.DoubleType()),
        T.StructField("review_scores_checkin", T.DoubleType()),
        T.StructField("review_scores_communication", T.DoubleType()),
        T.StructField("review_scores_location", T.DoubleType()),
        T.StructField("review_scores_value", T.DoubleType()),
        T.StructField("price", T.DoubleType()),
    ]
)
LISTING_KEYS = ["longitude", "latitude"]
TARGET = "price"
COMPOSITE = "aggregated_review_scores"
LINEAGE = "input_file_name"
REVIEW_SCORES = [name for name in LISTING_SCHEMA.names if name.startswith("review_scores_")]
# -----------------------------------------------------------------------------------------------------


def with_composite(schema: T.StructType, composite_type: T.DataType) -> T.StructType:
    """`schema` with the composite score placed before its last field, the target."""
    return T.StructType([*schema.fields[:-1], T.StructField(COMPOSITE, composite_type), schema.fields[-1]])


def doubles_for_counts(schema: T.StructType) -> T.StructType:
    """`schema` with its long columns turned to double, the types a model is trained on."""
    return T.StructType(
        [T.StructField(f.name, T.DoubleType() if f.dataType == T.LongType() else f.dataType) for f in schema]
    )


# Input of the model. The score is a number here; a model trained on the score as a category needs
# with_composite(doubles_for_counts(LISTING_SCHEMA), StringType()) instead.
SCORING_SCHEMA = with_composite(doubles_for_counts(LISTING_SCHEMA), T.DoubleType())
