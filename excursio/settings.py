"""Everything a caller may set, and the fixed values of the page rules."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

# ---- fixed values: they decide the results and must stay as they are --------

IMAGE_HOSTS = ("cdn.rzervit", "cdn.delite")
IMAGE_LIMIT = 10
IMAGE_JUNK = ("logo", "favicon", "map-pin", "arrow-down")
GALLERY_JUNK = ("logo", "favicon", "map-pin")

API_URL_JUNK = (".js", "chunk", "webpack", "analytics", "gtag", "google", "ipapi")
API_KEY_JUNK = ("ipapi", "track/init", "track/event")
API_DATES_KEY = "bookabledates"

# First matching rule wins; every rule holds if one of its words occurs.
CATEGORY_RULES = (
    ("museums", ("museum", "gallery")),
    ("religious-sites", ("temple", "shrine", "church", "mosque", "spiritual",
                         "religious", "aarti", "kashi")),
    ("historical-monuments", ("monument", "fort", "palace", "heritage", "history", "culture")),
    ("theme-parks", (("theme", "park"),)),  # both words
    ("parks", ("park",)),
    ("gardens", ("garden",)),
    ("zoos", ("zoo", "safari", "wildlife")),
    ("beaches", ("beach",)),
    ("islands", ("island",)),
    ("rivers", ("river", "boat", "ganges", "ghat")),
    ("mountains", ("mountain",)),
    ("hills", ("hill",)),
    ("lakes", ("lake",)),
    ("water-sports", ("water", "diving", "kayak", "rafting")),
    ("tours", ("tour", "walk", "sightseeing", "expedition")),
    ("sports", ("sport", "outdoor", "trek")),
    ("transportation", ("transport", "taxi", "cab", "transfer")),
    ("entertainment", ("show", "event", "entertainment", "leisure", "music")),
)
CATEGORY_FALLBACK = "attractions"

# Key in the plan, full name; the lower-cased key closes a day as well.
WEEK = (
    ("Mon", "monday"), ("Tues", "tuesday"), ("Weds", "wednesday"), ("Thur", "thursday"),
    ("Fri", "friday"), ("Sat", "saturday"), ("Sun", "sunday"),
)
OPENS, CLOSES = "10:00 AM", "06:00 PM"
TICKET_DELIVERY = "Instant Confirmation & Digital E-Ticket"
# ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    """Job parameters. ``run_ts`` stamps every record of one run."""

    run_ts: datetime = datetime(2026, 1, 1, tzinfo=timezone.utc)
    rules: str = "v4"
    provider: str = ""
    source: str = "ONDC"
    default_city: str = "Kolkata"
    country: str = "India"
    country_code: str = "IND"
    currency: str = "INR"
    fallback_price: float = 50.0
    image_hosts: tuple[str, ...] = IMAGE_HOSTS
    category_rules: tuple = CATEGORY_RULES

    def __post_init__(self) -> None:
        if self.rules not in ("v3", "v4"):
            raise ValueError(f"rules must be v3 or v4, not {self.rules!r}")

    @classmethod
    def for_now(cls, **values) -> Settings:
        """Settings stamped with the present time."""
        return cls(run_ts=datetime.now(timezone.utc), **values)

    @property
    def run_iso(self) -> str:
        utc = self.run_ts.astimezone(timezone.utc)
        return f"{utc:%Y-%m-%dT%H:%M:%S}.{utc.microsecond // 1000:03d}Z"
