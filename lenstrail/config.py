"""Fixed values of the analysis.

They must equal the published study's values for the results to match, so they are
stated once, here, as plain text.  Every operator takes them as keyword defaults.
"""

from __future__ import annotations

from typing import NamedTuple


class Box(NamedTuple):
    """A latitude/longitude rectangle in degrees; all four bounds are inclusive."""

    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float


class Roi(NamedTuple):
    """A named region of interest.  Position in the sequence is its priority."""

    name: str
    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float

    @property
    def centre(self) -> tuple[float, float]:
        """(latitude, longitude) of the box midpoint."""
        return (self.lat_min + self.lat_max) / 2, (self.lon_min + self.lon_max) / 2


# --- fixed values -----------------------------------------------------------------

CITY_BOX = Box(41.6, 42.2, 12.2, 12.8)

ROIS: tuple[Roi, ...] = (
    Roi("Colosseo", 41.889, 41.891, 12.491, 12.494),
    Roi("Vaticano", 41.900, 41.906, 12.450, 12.460),
    Roi("Pantheon", 41.897, 41.899, 12.475, 12.478),
    Roi("FontanaTrevi", 41.900, 41.902, 12.482, 12.484),
    Roi("Trastevere", 41.886, 41.892, 12.465, 12.472),
    Roi("StazioneTermini", 41.900, 41.903, 12.498, 12.504),
    Roi("PiazzaNavona", 41.898, 41.900, 12.472, 12.474),
    Roi("PiazzaSpagna", 41.905, 41.907, 12.481, 12.484),
    Roi("VillaBorghese", 41.910, 41.918, 12.475, 12.495),
)

UNKNOWN_ROI = "Unknown"

# Names under which the capture date may appear, in order of preference.
DATE_FIELDS = ("dateTaken", "DateTaken", "datetaken")
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "MMM d, yyyy h:mm:ss a")

# Dates before this year are default dates of the camera or the site.
FIRST_REAL_YEAR = 2000
FIRST_PLAUSIBLE_YEAR = 1500

STOP_WORDS = ("rome", "roma", "italy", "italia", "lazio", "photo", "flickr")

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# User segmentation, in calendar days between the first and the last photo.
RESIDENT_DAYS = 30
TOURIST_DAYS = 7
MANY_ROIS = 4

# Hexagon grid: origin and metres per degree at the city's latitude.
HEX_ORIGIN = (41.89, 12.49)
METRES_PER_DEG_LAT = 111320.0
METRES_PER_DEG_LON = 82870.0
SQRT3 = 1.7320508075688772
