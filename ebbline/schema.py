"""Event-log schema and the page, device and browser names results depend on."""

from pyspark.sql import types as T

USER = "userId"

EVENT_LOG_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("page", T.StringType()),
        T.StructField("artist", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("registration", T.LongType()),
        T.StructField("sessionId", T.LongType()),
        T.StructField("userAgent", T.StringType()),
    ]
)

# Page names as the application logs them.
CHURN_PAGES = ("Cancellation Confirmation",)
CHURN_PAGES_WIDE = ("Cancellation Confirmation", "Cancel")
PLAY_PAGE = "NextSong"
POSITIVE_PAGES = ("Thumbs Up", "Thumbs Down", "Add Friend", "Add to Playlist")
# The same list with the spelling that never matches a logged page.
POSITIVE_PAGES_MISSPELT = ("Thumbs Up", "Thumbs Down", "Add Friend", "Add to playlist")
NEGATIVE_PAGES = ("Error", "Help")
THUMBS_PAGES = ("Thumbs Up", "Thumbs Down")
SERVICE_PAGES = (
    "Downgrade",
    "Upgrade",
    "Submit Upgrade",
    "Submit Downgrade",
    "Cancel",
    "Cancellation Confirmation",
)
SERVICE_EXIT_PAGES = ("Downgrade", "Submit Downgrade", "Cancel", "Cancellation Confirmation")
PIVOT_EXCLUDED_PAGES = ("Cancel", "Cancellation Confirmation", "NextSong")
PIVOT_PAGES = (
    "About",
    "Add Friend",
    "Add to Playlist",
    "Downgrade",
    "Error",
    "Help",
    "Home",
    "Login",
    "Logout",
    "Register",
    "Roll Advert",
    "Save Settings",
    "Settings",
    "Submit Downgrade",
    "Submit Registration",
    "Submit Upgrade",
    "Thumbs Down",
    "Thumbs Up",
    "Upgrade",
)

# User-agent families used as one-hot columns.
DEVICE_FAMILIES = ("iOS", "Linux", "Other", "Ubuntu", "Mac OS X", "Windows")
BROWSER_FAMILIES = (
    "Firefox",
    "Safari",
    "Other",
    "Chromium",
    "Google",
    "Mobile Safari",
    "IE",
    "Chrome",
)

# Day names in the order results use.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# Columns of the training matrix, label aside.
DEVICE_COLUMNS = tuple(f"device_{name}" for name in DEVICE_FAMILIES)
BROWSER_COLUMNS = tuple(f"browser_{name}" for name in BROWSER_FAMILIES)
MODEL_FEATURES = (
    "avg_daily_listens",
    "song_counts",
    "level_flag",
    "pos_interactions",
    "neg_interactions",
    "distinct_artist",
    *PIVOT_PAGES,
    *DEVICE_COLUMNS,
    *BROWSER_COLUMNS,
    "days_since_registration",
)
