"""The standard two-feed run: feed layouts, categories, rules.

Everything here is configuration of the generic operators; other feeds bring
their own specs.
"""

from __future__ import annotations

from pyspark.sql import types as T

from ..operators.shape import FeedSpec

# Column names and words of the two feeds.

FLAT_COLUMNS = (
    "id",
    "name",
    "brewery_type",
    "address_1",
    "address_2",
    "address_3",
    "city",
    "state_province",
    "postal_code",
    "country",
    "phone",
    "website_url",
    "longitude",
    "latitude",
)
COORDINATE_COLUMNS = ("latitude", "longitude")

FLAT_SCHEMA = T.StructType(
    [
        T.StructField(c, T.DoubleType() if c in COORDINATE_COLUMNS else T.StringType())
        for c in FLAT_COLUMNS
    ]
)

NESTED_SCHEMA = T.StructType(
    [
        T.StructField("Id", T.StringType()),
        T.StructField("Name", T.StringType()),
        T.StructField("Brewery_Type__c", T.StringType()),
        T.StructField("Phone", T.StringType()),
        T.StructField("Website", T.StringType()),
        T.StructField("Membership_Record_Status__c", T.StringType()),
        T.StructField("Is_Craft_Brewery__c", T.BooleanType()),
        T.StructField(
            "BillingAddress",
            T.StructType(
                [
                    T.StructField("street", T.StringType()),
                    T.StructField("city", T.StringType()),
                    T.StructField("state", T.StringType()),
                    T.StructField("postalCode", T.StringType()),
                    T.StructField("country", T.StringType()),
                    T.StructField("latitude", T.DoubleType()),
                    T.StructField("longitude", T.DoubleType()),
                ]
            ),
        ),
    ]
)

CATEGORIES = {
    "micro": "microbrewery",
    "nano": "microbrewery",
    "taproom": "taproom",
    "bar": "taproom",
    "beergarden": "taproom",
    "brewpub": "brewpub",
    "regional": "regional",
    "contract": "contract",
    "large": "large",
}
ACCEPTED_CATEGORIES = (
    "microbrewery",
    "taproom",
    "brewpub",
    "regional",
    "contract",
    "large",
    "Unknown",
)
EXCLUDED_TYPES = ("Alt Prop", "Office only location", "Location", "Beer Brand")
COUNTRY = "United States"

BOUNDS = {"latitude": (-90.0, 90.0), "longitude": (-180.0, 180.0)}

# End of fixed values.

LEFT_ID = "brewery_id"
RIGHT_ID = "partner_brewery_id"
MATCH_KEYS = ("name", "city", "state_province")
ATTRIBUTES = (
    "name",
    "brewery_type",
    "street_address",
    "city",
    "state_province",
    "postal_code",
    "country",
    "phone",
    "website_url",
    "longitude",
    "latitude",
)
FILLED = ("phone", "website_url")

# The flat feed with bounded coordinates, everything else as read.
FLAT_STAGED = FeedSpec(columns={c: c for c in FLAT_COLUMNS}, bounds=BOUNDS)

# The flat feed in standard form.
FLAT_STANDARD = FeedSpec(
    columns={
        LEFT_ID: "id",
        "name": "name",
        "brewery_type": "brewery_type",
        "street_address": ("address_1", "address_2", "address_3"),
        "city": "city",
        "state_province": "state_province",
        "postal_code": "postal_code",
        "country": "country",
        "longitude": "longitude",
        "latitude": "latitude",
        "phone": "phone",
        "website_url": "website_url",
    },
    bounds=BOUNDS,
    categories={"brewery_type": CATEGORIES},
    phones=("phone",),
)

# The nested feed in standard form: marked rows only, types lower-cased, not mapped.
NESTED_STANDARD = FeedSpec(
    columns={
        RIGHT_ID: "Id",
        "name": "Name",
        "brewery_type": "Brewery_Type__c",
        "street_address": "BillingAddress.street",
        "city": "BillingAddress.city",
        "state_province": "BillingAddress.state",
        "postal_code": "BillingAddress.postalCode",
        "country": "BillingAddress.country",
        "phone": "Phone",
        "website_url": "Website",
        "latitude": "BillingAddress.latitude",
        "longitude": "BillingAddress.longitude",
        "membership_status": "Membership_Record_Status__c",
    },
    bounds=BOUNDS,
    lowered=("brewery_type",),
    true_flags=("Is_Craft_Brewery__c",),
    excluded={"Brewery_Type__c": EXCLUDED_TYPES},
)
