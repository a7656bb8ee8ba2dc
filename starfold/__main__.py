import sys

from starfold.cli import main

sys.exit(main())
