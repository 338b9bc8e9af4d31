from reelstat.plans.cli import silver_events

if __name__ == "__main__":
    print("[silver_events] rows written:", silver_events())
