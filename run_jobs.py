"""Start the station jobs: ``spark-submit --py-files gaugeline.zip run_jobs.py --help``."""

from gaugeline.jobs import main

main()
