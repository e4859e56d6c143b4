import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tripcast.schema import TRIP_SCHEMA, ZONE_SCHEMA  # noqa: E402
from tripcast.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app="tripcast-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tripcast-test-ckpt-"))
    yield s
    s.stop()


# The five sample trips published with the data dictionary.
# Rows 4 and 5 break fare - pay = profit (by 4.00 and 5.00); row 2 has a
# negative profit.
SAMPLE_CSV = """business,pickup_location,dropoff_location,trip_length,request_to_pickup,total_ride_time,on_scene_to_pickup,on_scene_to_dropoff,time_of_day,date,passenger_fare,driver_total_pay,rideshare_profit,hourly_rate,dollars_per_mile
Uber,102,157,2.08,119,648,79,727,evening,1684713600,12.61,9.1,3.51,45.06,4.38
Uber,235,244,1.7,59,1226,27,1253,evening,1684713600,13.57,13.75,-0.18,39.51,8.09
Uber,79,170,2.02,438,835,31,866,morning,1684800000,26.26,21.14,5.12,87.88,10.47
Uber,256,196,6.27,180,1362,26,1388,morning,1684713600,31.21,25.04,10.17,64.95,3.99
Uber,230,43,1.63,72,637,65,702,morning,1684713600,24.44,13.13,16.31,67.33,8.06
"""

# The five published sample rows of the zone lookup, plus two
# rows of our own for the 'Unknown' ids with NA-like names and an empty field.
ZONES_CSV = """LocationID,Borough,Zone,service_zone
1,EWR,Newark Airport,EWR
2,Queens,Jamaica Bay,Boro Zone
3,Bronx,Allerton/Pelham Gardens,Boro Zone
4,Manhattan,Alphabet City,Yellow Zone
5,Staten Island,Arden Heights,Boro Zone
264,Unknown,NV,N/A
265,Unknown,NA,
"""


def trip(business="Uber", pu=1, do=2, length=1.0, wait=None, tod="morning",
         date=1684713600, fare="10.00", pay="8.00", profit="2.00", hourly=None, per_mile=None):
    from decimal import Decimal
    return (business, pu, do, length, wait, None, None, None, tod, date,
            Decimal(fare) if fare is not None else None,
            Decimal(pay) if pay is not None else None,
            Decimal(profit) if profit is not None else None, hourly, per_mile)


@pytest.fixture
def make_trips(spark):
    def _make(rows):
        return spark.createDataFrame(rows, TRIP_SCHEMA)
    return _make


@pytest.fixture
def zones(spark):
    rows = [(1, "EWR", "Newark Airport", "EWR"),
            (2, "Queens", "Jamaica Bay", "Boro Zone"),
            (3, "Bronx", "Allerton/Pelham Gardens", "Boro Zone"),
            (4, "Manhattan", "Alphabet City", "Yellow Zone"),
            (5, "Queens", "Astoria", "Boro Zone"),
            (6, "Manhattan", "Astoria", None),
            (264, "Unknown", "NV", "N/A"),
            (265, "Unknown", "NA", None)]
    return spark.createDataFrame(rows, ZONE_SCHEMA)
