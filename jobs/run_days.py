from reelstat.plans.cli import run_days

if __name__ == "__main__":
    print("[run_days] rows written:", run_days())
