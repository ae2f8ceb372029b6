import sys

from ontime_analytics.jobs import main

sys.exit(main())
