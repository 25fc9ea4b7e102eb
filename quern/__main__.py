import sys

from quern.plans.pipeline import main

sys.exit(main())
