"""Default parameters."""

# Fixed values that results depend on.
MIN_TRIPS = 100
TRAIN_WEEKS = 3
TEST_WEEKS = 1
BURN_IN_DAYS = 7
EMPTY_THRESHOLD = 0.1
FULL_THRESHOLD = 0.9
DEFAULT_CAPACITY = 30.0
DEFAULT_BIKES = 15.0
MAPE_EPSILON = 1.0
LAT_MIN, LAT_MAX = 40.4, 41.0
LNG_MIN, LNG_MAX = -74.3, -73.6
HOUR = 3600
