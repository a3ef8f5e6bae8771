"""spark-submit entry point for the command line:

    spark-submit --py-files basketry.zip submit.py build ROOT
"""

import sys

from basketry.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
