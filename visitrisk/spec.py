"""The one list of features that every operator uses."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import types as T

ENCODED_SUFFIX = "_ENCODED"


@dataclass(frozen=True)
class FeatureSpec:
    """Columns of a visit table and the role each one plays.

    The model order is boolean, categorical (encoded), numeric, each in the order given here.
    ``day_partition`` names a partition column that holds the date of ``event_time``; when the
    table has it, day filters prune its partitions as well.
    """

    boolean: tuple[str, ...]
    categorical: tuple[str, ...]
    numeric: tuple[str, ...]
    target: str
    id: str
    event_time: str
    day_partition: str | None = None

    @property
    def raw_features(self) -> tuple[str, ...]:
        return self.boolean + self.categorical + self.numeric

    @property
    def encoded(self) -> tuple[str, ...]:
        return tuple(c + ENCODED_SUFFIX for c in self.categorical)

    @property
    def model_features(self) -> tuple[str, ...]:
        return self.boolean + self.encoded + self.numeric

    def available(self, columns: Iterable[str]) -> FeatureSpec:
        """The same spec without the features that ``columns`` lacks."""
        present = {c.lower() for c in columns}

        def keep(names: tuple[str, ...]) -> tuple[str, ...]:
            return tuple(n for n in names if n.lower() in present)

        return replace(
            self,
            boolean=keep(self.boolean),
            categorical=keep(self.categorical),
            numeric=keep(self.numeric),
        )

    def cleaned_schema(self, id_type: T.DataType | None = None) -> T.StructType:
        """Schema of cleaned features, led by the id when its type is given."""
        fields = [T.StructField(self.id, id_type)] if id_type is not None else []
        fields += [T.StructField(c, T.IntegerType()) for c in self.boolean]
        fields += [T.StructField(c, T.StringType()) for c in self.categorical]
        fields += [T.StructField(c, T.DoubleType()) for c in self.numeric]
        return T.StructType(fields)


# Column names of the visit table and of the score table, in model order.
BOOLEAN_COLUMNS = (
    "IP_API_HOSTING",
    "IP_API_MOBILE",
    "IP_API_PROXY",
)

CATEGORICAL_COLUMNS = (
    "IP_API_CITY",
    "IP_API_COUNTRY",
    "IP_API_COUNTRY_CODE",
    "IP_API_ORG",
    "IP_API_REGION",
    "IP_API_STATUS",
    "IP_API_TIMEZONE",
    "BROWSERNAME",
    "BROWSERVERSION",
    "DEVICECATEGORY",
    "DEVICETYPE",
    "OPERATINGSYSTEM",
    "OPERATINGSYSTEMVERSION",
    "PROPERTY_NAME",
    "PUBLISHER_NAME",
    "UTM_CONTENT",
    "UTM_TERM",
    "UTM_MEDIUM",
    "UTM_SOURCE",
    "VISITOR_TYPE",
    "DOMAIN",
    "STATE",
    "EMAIL_VERIFICATION_RESPONSE",
)

NUMERIC_COLUMNS = (
    "IP_API_LATITUDE",
    "IP_API_LONGITUDE",
    "VISIT_COUNT_FORM_COMPLETED_MEASURE",
    "VISIT_COUNT_FORM_STARTED_MEASURE",
    "VISIT_COUNT_VISIT_TO_PAGE_1_MEASURE",
    "VISIT_COUNT_PAGE_1_TO_PAGE_2_MEASURE",
    "VISIT_COUNT_PAGE_2_TO_PAGE_3_MEASURE",
    "SECONDS_SPENT_FORM_MEASURE",
    "SECONDS_SPENT_FORM_COMPLETE_MEASURE",
    "SECONDS_SPENT_PAGE_1_TO_2_MEASURE",
    "SECONDS_SPENT_PAGE_2_TO_3_MEASURE",
    "SECONDS_SPENT_VISIT_TO_PAGE_1_MEASURE",
    "SECONDS_SPENT_ZAN_PRIMARY_MEASURE",
    "SECONDS_SPENT_ZAN_PRIMARY_COMPLETE_MEASURE",
    "SECONDS_SPENT_ZAN_PRIMARY_INCOMPLETE_MEASURE",
    "VISIT_COUNT_ZAN_COMPLETED_LESS_THAN_7_SECONDS_MEASURE",
    "VISIT_COUNT_ZAN_PRIMARY_COMPLETE_MEASURE",
    "VISIT_COUNT_ZAN_PRIMARY_LOAD_MEASURE",
    "VISIT_COUNT_ZAN_SPENT_MORE_THAN_5_MINS_MEASURE",
    "LTV_PIXEL_CAMPAIGN_CLICKS_MEASURE",
    "LTV_PIXEL_CAMPAIGN_IMPRESSIONS_MEASURE",
    "LTV_PIXEL_PURCHASE_COUNT_MEASURE",
    "LTV_PIXEL_REVENUE_MEASURE",
    "LTV_PIXEL_ADVERTISER_COST_MEASURE",
    "FICTITIOUS_CHARACTERS_NAME_MEASURE",
    "FLAGGED_ADDRESS_MEASURE",
    "FLAGGED_NAME_MEASURE",
    "FNLN_EMAIL_STRING_MEASURE",
    "IPQS_FLAGGED_LOCATION_MEASURE",
    "MISSING_ADDRESS_NUMBER_MEASURE",
    "MISSING_STREET_TYPE_MEASURE",
    "VISITS_WITH_PII_COMPLETE_VISITS",
    "RECYCLED_IP_ADDRESS_MEASURE",
    "SINGLE_LETTER_STRING_NAME_MEASURE",
    "THREE_LETTER_STRING_NAME_MEASURE",
    "TWO_LETTER_STRING_NAME_MEASURE",
    "THREE_LETTER_STRING_LEFT_RIGHT_NAME_MEASURE",
    "VULGAR_WORDS_NAME_MEASURE",
    "VISIT_COUNT_ZAN_PRIMARY_INCOMPLETE_MEASURE",
    "POSITION_1_ANSWERS_MEASURE",
    "CAMPAIGN_CLICKS_MEASURE",
    "CAMPAIGN_CONVERSIONS_MEASURE",
    "CAMPAIGN_IMPRESSIONS_MEASURE",
    "CPA_CLICKS_MEASURE",
    "CPA_CONVERSIONS_MEASURE",
    "CPA_IMPRESSIONS_MEASURE",
    "CPA_REVENUE_MEASURE",
    "CPC_CONVERSIONS_MEASURE",
    "CPC_IMPRESSIONS_MEASURE",
    "CPC_REVENUE_MEASURE",
    "CPL_CONVERSIONS_MEASURE",
    "CPL_IMPRESSIONS_MEASURE",
    "CPL_REVENUE_MEASURE",
    "TOTAL_GROSS_REVENUE_MEASURE",
    "LAST_POSITION_ANSWERS_MEASURE",
    "TOTAL_NET_REVENUE_MEASURE",
    "PREPING_SCORE_1_PRIMARY_VISITS",
    "PREPING_SCORE_2_PRIMARY_VISITS",
    "PREPING_SCORE_3_PRIMARY_VISITS",
    "PREPING_SCORE_4_PRIMARY_VISITS",
    "PREPING_SCORE_5_PRIMARY_VISITS",
    "PRIMARY_GROSS_REVENUE_MEASURE",
    "QUESTIONS_ANSWERED_MEASURE",
    "QUESTIONS_IMPRESSED_MEASURE",
    "QUESTIONS_IMPRESSED_FOR_POSITION_RATE_MEASURE",
    "ZAN_SECONDARY_END_OF_PLACEMENT_VISITS_MEASURE",
    "QUESTIONS_ANSWERED_FOR_POSITION_RATE_MEASURE",
    "ZAN_SECONDARY_PLACEMENT_VISITS_MEASURE",
    "SECONDARY_NET_REVENUE_MEASURE",
)

VISIT_SPEC = FeatureSpec(
    boolean=BOOLEAN_COLUMNS,
    categorical=CATEGORICAL_COLUMNS,
    numeric=NUMERIC_COLUMNS,
    target="IPQS_DEVICE_FP_FRAUD_SCORE",
    id="VISIT_ID",
    event_time="CREATED_AT",
)
