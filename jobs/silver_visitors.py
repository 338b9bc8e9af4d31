from reelstat.plans.cli import silver_visitors

if __name__ == "__main__":
    print("[silver_visitors] rows written:", silver_visitors())
