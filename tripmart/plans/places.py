"""Where generated trips begin and end unless a caller brings places of their own."""

from __future__ import annotations

from hashlib import md5

# Latitude and longitude bounds of the named areas.
AREAS = {
    "Financial District": (40.703, 40.712, -74.018, -74.008),
    "Midtown": (40.748, 40.761, -73.985, -73.968),
    "Upper East Side": (40.768, 40.787, -73.959, -73.947),
    "Upper West Side": (40.775, 40.799, -73.982, -73.962),
    "Harlem": (40.799, 40.816, -73.952, -73.932),
    "East Village": (40.720, 40.732, -73.985, -73.975),
    "Williamsburg": (40.705, 40.718, -73.965, -73.945),
    "DUMBO": (40.699, 40.704, -73.998, -73.987),
    "Park Slope": (40.668, 40.680, -73.990, -73.975),
    "Coney Island": (40.570, 40.580, -74.000, -73.975),
    "Brooklyn Heights": (40.694, 40.702, -74.005, -73.991),
    "Astoria": (40.756, 40.776, -73.928, -73.905),
    "Long Island City": (40.740, 40.755, -73.960, -73.935),
    "Flushing": (40.755, 40.770, -73.835, -73.810),
    "Jackson Heights": (40.745, 40.755, -73.885, -73.870),
    "Fordham": (40.855, 40.865, -73.900, -73.885),
    "Pelham Bay": (40.845, 40.860, -73.825, -73.800),
    "St. George": (40.635, 40.645, -74.080, -74.065),
    "Tottenville": (40.505, 40.515, -74.255, -74.240),
    "JFK Airport": (40.635, 40.655, -73.790, -73.760),
    "LaGuardia Airport": (40.770, 40.780, -73.885, -73.860),
    "Newark Airport": (40.680, 40.700, -74.190, -74.160),
    "Jersey City": (40.710, 40.730, -74.055, -74.030),
    "Hoboken": (40.735, 40.745, -74.035, -74.020),
    "Newark": (40.725, 40.745, -74.190, -74.140),
    "Elizabeth": (40.655, 40.675, -74.220, -74.190),
    "Nassau County": (40.720, 40.800, -73.650, -73.500),
    "Suffolk County": (40.800, 40.950, -73.200, -72.700),
    "Yonkers": (40.925, 40.945, -73.900, -73.880),
    "White Plains": (41.025, 41.040, -73.780, -73.760),
    "Stamford": (41.035, 41.060, -73.570, -73.520),
}
# The areas most trips begin in, the weights, and the bounds of the outlying areas.
CORE = (
    "Financial District", "Midtown", "Upper East Side", "Upper West Side", "Williamsburg", "DUMBO", "Park Slope", "Astoria",
    "Long Island City", "Fordham", "St. George", "JFK Airport", "LaGuardia Airport", "Jersey City",
)
CORE_WEIGHT, AIRPORT_WEIGHT, NAMED_WEIGHT, OUTER_WEIGHT = 15, 8, 5, 1
OUTER_AREAS = 125
OUTER_LAT, OUTER_LON = (40.5, 42.0), (-74.5, -71.5)
LAT_REACH, LON_REACH = (0.005, 0.02), (0.005, 0.03)
# How often a place is drawn; all others weigh 1.
LOCATION_WEIGHTS = {
    "Manhattan": 35, "Brooklyn": 35, "Queens": 30, "Bronx": 30, "Staten Island": 25,
    "Boston": 20, "Philadelphia": 20, "Pittsburgh": 18, "Toronto": 20, "Ottawa": 18,
    "Montreal": 18, "Providence": 18, "Newark": 18, "Jersey City": 18, "Bridgeport": 15,
    "New Haven": 15, "Hartford": 15, "Stamford": 15,
    "Cambridge": 12, "Lowell": 10, "Brockton": 10, "Mississauga": 12, "Brampton": 12,
    "Hamilton": 12, "London": 10, "Markham": 12, "Vaughan": 12, "Kingston": 10,
    "Windsor": 10, "Paterson": 12, "Elizabeth": 12, "Edison Township": 10, "Clifton": 10,
    "Allentown": 10, "Erie": 8, "Scranton": 8, "Lancaster": 8, "York": 8,
    "Warwick": 10, "Cranston": 10, "Waterbury": 8, "Norwalk": 10, "Danbury": 8,
    "Worcester": 10, "Springfield": 8, "New Bedford": 8, "Lynn": 8, "Quincy": 8,
    "Fall River": 8, "Portland": 8, "Burlington": 8, "Manchester": 8,
}

Area = tuple[str, float, float, float, float, int]


def area_weight(name: str) -> int:
    if name in CORE:
        return CORE_WEIGHT
    if "Airport" in name:
        return AIRPORT_WEIGHT
    return NAMED_WEIGHT if name in AREAS else OUTER_WEIGHT


def _between(salt: str, low: float, high: float) -> float:
    """The same number in every run: a share of the span, taken from a digest of the salt."""
    return round(low + int(md5(salt.encode()).hexdigest()[:12], 16) / 16**12 * (high - low), 6)


def outer_area(number: int) -> Area:
    """A box around a point of the outlying country."""
    name = f"Area_{number:03}"
    lat, lon = _between(f"{name} lat", *OUTER_LAT), _between(f"{name} lon", *OUTER_LON)
    reach = lambda side, span: _between(f"{name} {side}", *span)
    return (name, round(lat - reach("south", LAT_REACH), 6), round(lat + reach("north", LAT_REACH), 6),
            round(lon - reach("west", LON_REACH), 6), round(lon + reach("east", LON_REACH), 6), OUTER_WEIGHT)


def default_areas(outer: int = OUTER_AREAS) -> list[Area]:
    """(name, lat_min, lat_max, lon_min, lon_max, weight) of the named areas and of ``outer`` more around them."""
    return [(name, *box, area_weight(name)) for name, box in AREAS.items()] + [outer_area(k) for k in range(1, outer + 1)]


def location_weights(places: list[str]) -> dict[str, int]:
    """The weight of each of some places."""
    return {place: LOCATION_WEIGHTS.get(place, 1) for place in places}
