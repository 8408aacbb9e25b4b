"""Launcher for spark-submit: spark-submit run_build.py --csv ... --out ..."""

from marketlens.jobs.build import main

if __name__ == "__main__":
    main()
