"""Entry point for spark-submit; see ``python submit.py --help``."""

from tallystream.cli import main

if __name__ == "__main__":
    main()
