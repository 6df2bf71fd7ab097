"""Start script for ``spark-submit --py-files shoptrail.zip submit.py JOB ...``."""

from shoptrail.__main__ import main

main()
