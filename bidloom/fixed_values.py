"""They must equal the data contract for the results to be right."""

# Salt buckets of the high-frequency branch.
SALT_BUCKETS = 16

# Lower bounds and labels, highest first; below the last bound the default applies.
PRICE_BUCKETS = ((4.0, "premium"), (2.0, "standard"))
PRICE_BUCKET_DEFAULT = "low"
SCORE_BANDS_UNIT = ((0.75, "very_high"), (0.50, "high"), (0.25, "medium"))
SCORE_BANDS_PERCENT = ((75, "very_high"), (50, "high"), (25, "medium"))
SCORE_BAND_DEFAULT = "low"

# Event quality: test traffic, expensive bids, everything else.
QUALITY_TEST = 0.10
QUALITY_PREMIUM = 0.95
QUALITY_PREMIUM_FROM = 4.0
QUALITY_DEFAULT = 0.70

HIGH = "high"
LOW = "low"
HOT_USER_PREFIX = "hot_user_"
BRANCH_HIGH = "high_frequency_salted"
BRANCH_LOW = "low_frequency_hash"
TIME_BUCKET_MINUTES = 5

# Output contract of the enrichment job.
GROUP_KEYS = (
    "advertiser_id",
    "campaign_id",
    "contextual_id",
    "frequency_bracket",
    "content_category",
    "koa_group",
)
FINAL_COLUMNS = GROUP_KEYS + (
    "salt",
    "branch",
    "event_count",
    "bid_count",
    "impression_count",
    "eligible_user_count",
    "feature_event_count",
    "avg_bid_price",
    "avg_clearing_price",
    "avg_quality_weighted_price",
    "avg_sib_score",
)
FINAL_ORDER = ("advertiser_id", "campaign_id", "contextual_id", "frequency_bracket", "branch")

# Row counts of the synthetic datasets per scale preset.
SCALES = {
    "tiny": dict(bids=100_000, impressions=70_000, contextual=20_000, matched=20_000,
                 advertiser=1_000, settings=1_000, features=50_000, sib=20_000),
    "small": dict(bids=1_000_000, impressions=700_000, contextual=200_000, matched=200_000,
                  advertiser=10_000, settings=10_000, features=500_000, sib=100_000),
    "smalllevel2": dict(bids=1_500_000, impressions=1_050_000, contextual=300_000, matched=300_000,
                        advertiser=12_000, settings=12_000, features=750_000, sib=150_000),
    "lightmedium": dict(bids=3_000_000, impressions=2_100_000, contextual=500_000, matched=500_000,
                        advertiser=15_000, settings=15_000, features=1_000_000, sib=250_000),
    "medium": dict(bids=10_000_000, impressions=7_000_000, contextual=1_000_000, matched=1_000_000,
                   advertiser=25_000, settings=25_000, features=3_000_000, sib=500_000),
}

# Task diagnosis thresholds: (lower bound, label), highest first.
SKEW_RATIO_CLASSES = ((5.0, "likely"), (3.0, "watch"))
GC_SHARE_CLASSES = ((0.50, "severe"), (0.20, "pressure"), (0.10, "watch"))
DIAGNOSIS_OK = "ok"
