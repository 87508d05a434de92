"""Audit which inputs each phase reads, from Spark's event log.

Usage: python tools/scan_audit.py [sf_dir]   (default /root/testdata/sf0.1)
Runs landing, staging, the shared per-day counts and the six trip reports
with one job group per phase, writes the event log to a fresh folder under
/tmp, and prints the records read by every input stage of each phase.
"""
import sys, json, glob, collections, os, tempfile
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
EV = tempfile.mkdtemp(prefix="urbanlake-eventlog-")
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled","false").config("spark.ui.showConsoleProgress","false")
         .config("spark.eventLog.enabled","true").config("spark.eventLog.dir",EV).config("spark.eventLog.compress","false")
         .config("spark.sql.shuffle.partitions","8").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
from urbanlake import sinks
from urbanlake.session import shared_dir
from urbanlake.sources import driver_tables as dt, landing as ld
from urbanlake.plans import staging as st, reports as rp
from urbanlake.operators.spatial import PolygonIndex
sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"; root = shared_dir(spark, "audit")
sc = spark.sparkContext
def put(name, df):
    sinks.write_table(df, f"{root}/{name}"); return sinks.scan_table(spark, f"{root}/{name}")
L = {t: put(t, ld.LAND[t](dt.RAW[t](spark, sf))) for t in dt.RAW}
print("landed trips", L["taxi_trips"].count())
zi, ai = PolygonIndex(L["boundaries_zip"], ["zip"]), PolygonIndex(L["comm_area"], ["area_numbe"])
sc.setJobGroup("stage_trips", "x"); trips = put("stg", st.stage_trips(L["taxi_trips"], zi, ai))
sc.setJobGroup("other", "x")
covid = put("cov", st.stage_covid(L["covid_by_zip"])); ccvi = put("ccvi", st.stage_ccvi(L["ccvi_by_ca"]))
print("staged trips", trips.count())
sc.setJobGroup("trip_day_facts", "x"); days = put("days", rp.trip_day_facts(trips, dt.TEST_AIRPORTS))
zips = L["boundaries_zip"]
for name, df in [("report1", rp.report1_severity(trips, covid, zips, days)), ("report2", rp.report2_airport(trips, covid, zips, dt.TEST_AIRPORTS, days)),
                 ("report3", rp.report3_ccvi(trips, ccvi, days)), ("report4a", rp.report4a_weekly(trips, zips, days)),
                 ("report4b", rp.report4b_monthly(trips, zips, days)), ("report4c", rp.report4c_daily(trips, zips, days))]:
    sc.setJobGroup(name, "x"); df.write.format("noop").mode("overwrite").save()
spark.stop()
stage_job = {}; recs = collections.defaultdict(collections.Counter)
for f in glob.glob(f"{EV}/**/*", recursive=True):
    if os.path.isdir(f) or "appstatus" in f: continue
    for line in open(f):
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart":
            for s in e["Stage IDs"]:
                stage_job[s] = e.get("Properties", {}).get("spark.jobGroup.id")
        if e["Event"] == "SparkListenerTaskEnd":
            g = stage_job.get(e["Stage ID"])
            r = ((e.get("Task Metrics") or {}).get("Input Metrics") or {}).get("Records Read", 0)
            if g and r: recs[g][e["Stage ID"]] += r
for g in ["stage_trips", "trip_day_facts", "report1", "report2", "report3", "report4a", "report4b", "report4c"]:
    print(g, sorted(recs[g].values(), reverse=True))
