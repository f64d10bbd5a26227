import logging

from txnscore.jobs import run

if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    run()
