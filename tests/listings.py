"""Fixed listing rows in the shape of the delivered data."""

from tideline.schemas import LISTING_SCHEMA, REVIEW_SCORES


def listing(place: int, **values):
    """One listing at its own coordinates; `values` override."""
    row = dict(
        host_is_superhost="0",
        cancellation_policy="Random",
        instant_bookable="1",
        host_total_listings_count=2.0,
        neighbourhood_cleansed="Random",
        latitude=10.0 + place,
        longitude=100.0 + place,
        property_type="Random Property Type",
        room_type="Random Room Type",
        accommodates=2.0,
        bathrooms=1.0,
        bedrooms=1.0 + place % 3,
        beds=1.0,
        bed_type="Random Bed Type",
        minimum_nights=1,
        number_of_reviews=5,
        price=50.0 + place,
    )
    row.update({name: 2.0 for name in REVIEW_SCORES})
    row.update(values)
    return tuple(row[name] for name in LISTING_SCHEMA.names)


def mock_rows(offset: int = 0):
    """Ten defective rows and a good one whose seven scores are 1."""
    broken = [
        listing(offset + i, cancellation_policy=None, neighbourhood_cleansed=" ") for i in range(10)
    ]
    return [*broken, listing(offset + 10, **{name: 1.0 for name in REVIEW_SCORES})]


def frame(spark, rows):
    return spark.createDataFrame(rows, LISTING_SCHEMA)
