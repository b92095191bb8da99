import sys

from fleetlens.cli import main

sys.exit(main())
